import json

import pytest
from pyspark.sql import functions as F

from scanlake import schemas
from scanlake.sources.records import (
    decode_records,
    encode_records,
    reject_items,
    reject_pages,
    reject_records,
    repo_inventory,
)


def test_repository_golden_text(spark):
    df = spark.createDataFrame([("testorg", "test-repo")], "org string, name string")
    text = encode_records(df).first().value
    assert text == '{"org":"testorg","name":"test-repo"}'
    back = decode_records(encode_records(df), schemas.REPOSITORY)
    assert [tuple(r) for r in back.collect()] == [("testorg", "test-repo")]


PAGES = {
    '[{"name":"zeta","org":"other"},{"name":"eta","size":[{}]}]': ["zeta", "eta"],
    '[{"name":"theta"},5,{"name":7},{"name":"iota"},null,"x",[{}],{"name":null},{}]': ["theta", "iota", "", ""],
    " [] \n": [],
    '[{"name":"kappa","name":"lambda"}]': None,
}
BROKEN_PAGES = [
    '[{"name":"mu"}', '[{"name":"mu"}] tail', '[{"name":"mu"}][]', '{"name":"mu"}', '{"name":{"x":1}}', "null", "", "7", None,
    '[{"name":"mu"}],', '[{"name":"mu"}],"\\u0001end of record\\u0001"]',
]


def test_inventory_keeps_what_is_good(values):
    good = {page: names for page, names in PAGES.items() if names is not None}
    pages = values([*good, *BROKEN_PAGES])
    got = sorted(tuple(r) for r in repo_inventory(pages, "me").collect())
    assert got == sorted(("me", name) for names in good.values() for name in names)
    refused = [r.value for r in reject_pages(pages).collect()]
    assert sorted(map(str, refused)) == sorted(map(str, BROKEN_PAGES))
    items = [(r.item_no, r.item) for r in reject_items(pages).orderBy("item_no").collect()]
    assert items == [(1, "5"), (2, '{"name":7}'), (4, "null"), (5, '"x"'), (6, "[{}]")]


GOOD = {
    '{"org":"a","worker_id":3}': ("a", 3),
    '{"worker_id":null,"org":null}': ("", 0),
    " {} \n": ("", 0),
    "null": ("", 0),
    '{"org":"5","worker_id":1}': ("5", 1),
    '{"org":"true"}': ("true", 0),
    '{"org":"[x"}': ("[x", 0),
    '{"org":"a","unknown":{"x":[1]}}': ("a", 0),
    '{"org":"a","org":"b"}': ("b", 0),
    '{"org":"}"}': ("}", 0),
    '{"org":"a","x":[{"y":{}}]}\r\n': ("a", 0),
}
BAD = [
    "", "{", '{"org":5}', '{"org":true}', '{"org":{"x":1}}', '{"org":["x"]}', '{"worker_id":"3"}', '{"worker_id":3.5}',
    '{"worker_id":99999999999}', '{"org":"a"} tail', '{"org":"a"}{"org":"b"}', '{"org":"a"},', "[]", "5", None,
    '{"processed_at":"2024-01-01"}', '{"processed_at":5}', '{"processed_at":"2024-13-01T00:00:00Z"}',
    '{"org":"a"}] }', '{"org":"a"},{"org":"b"}]}', '{"org":"a"},"\\u0001end of record\\u0001"]}', "{'org':'a'}", '{"org":"a"}}', '{org:"a"}', '{"worker_id":1e2}', '{"org":"a",}',
]


def test_strict_decoding(values):
    df = values([*GOOD, *BAD])
    decoded = decode_records(df, schemas.PROCESSED_REPOSITORY, keep=["value"]).select("value", "org", "worker_id")
    assert {r.value: (r.org, r.worker_id) for r in decoded.collect()} == GOOD
    rejected = [r.value for r in reject_records(df, schemas.PROCESSED_REPOSITORY).collect()]
    assert sorted(map(str, rejected)) == sorted(map(str, BAD))


def test_lenient_decoding_takes_numbers_as_text(values):
    df = values(['{"org":5}', '{"org":"a"} tail', '{"processed_at":"2024-01-01"}'])
    rows = decode_records(df, schemas.PROCESSED_REPOSITORY, strict=False)
    assert [tuple(r) for r in rows.select("org", F.col("processed_at").cast("string")).collect()] == [
        ("5", "0001-01-01 00:00:00"), ("", "2024-01-01 00:00:00")
    ]


@pytest.mark.parametrize(
    "text, valid",
    [
        ('{"valid_secrets":null}', True),
        ('{"valid_secrets":[]}', True),
        ('{"valid_secrets":[null]}', True),
        ('{"valid_secrets":[{"file":"7","line":1}]}', True),
        ('{"valid_secrets":[{"file":"x"},{"file":7}]}', False),
        ('{"valid_secrets":[{"line":"x"}]}', False),
        ('{"valid_secrets":{}}', False),
    ],
)
def test_types_are_checked_inside_arrays(values, text, valid):
    assert decode_records(values([text]), schemas.SECRET_SCAN).count() == valid


def test_times_keep_microseconds(values):
    df = values(['{"processed_at":"2024-01-01T01:00:00.123456789+02:00"}'])
    row = decode_records(df, schemas.PROCESSED_REPOSITORY).select(F.col("processed_at").cast("string").alias("t")).first()
    assert row.t == "2023-12-31 23:00:00.123456"


def test_scan_record_round_trip_omits_empty_fields(values):
    text = (
        '{"org":"o","name":"n","processed_at":"2024-01-01T00:00:00Z","scanned_at":"2024-01-01T00:00:01.5Z","worker_id":1,'
        '"valid_secrets_found":1,"valid_secrets":[{"secret_type":"AWS","description":"d","file":"f","line":2,"commit":"c",'
        '"confidence":"high","validated":true}],"scan_status":"success","scan_duration":5}'
    )
    decoded = decode_records(values([text]), schemas.SECRET_SCAN)
    row = decoded.select("error_message", "valid_secrets").first()
    assert row.error_message == "" and row.valid_secrets[0].service == ""
    encoded = encode_records(decoded, schemas.OMIT_EMPTY["secret_scan"]).first().value
    assert encoded == text


def test_raw_tool_output_round_trip(values):
    raw = {"DetectorName": "X", "ExtraData": {"k": "v"}, "StructuredData": {"a": [1]}, "SourceMetadata": {"Data": {"Git": {"line": 3}}}}
    row = decode_records(values([json.dumps(raw)]), schemas.RAW_SECRET).first()
    assert row.ExtraData == {"k": "v"}
    assert row.SourceMetadata.Data.Git.line == 3 and row.SourceMetadata.Data.Git.file == ""
    assert decode_records(values(['{"ExtraData":{"k":1}}']), schemas.RAW_SECRET).count() == 0
