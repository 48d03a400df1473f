"""Record schemas. Field names and order are the JSON wire format."""

from pyspark.sql import types as T

STRING = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
BOOL = T.BooleanType()
TIME = T.TimestampType()
STRINGS = T.ArrayType(STRING)


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


REPOSITORY = record(org=STRING, name=STRING)

PROCESSED_REPOSITORY = record(
    org=STRING, name=STRING, processed_at=TIME, worker_id=INT, clone_path=STRING
)

SECRET_FINDING = record(
    secret_type=STRING,
    description=STRING,
    file=STRING,
    line=INT,
    commit=STRING,
    confidence=STRING,
    validated=BOOL,
    service=STRING,
)

VULNERABILITY = record(
    id=STRING,
    package=STRING,
    version=STRING,
    ecosystem=STRING,
    severity=STRING,
    summary=STRING,
    details=STRING,
    aliases=STRINGS,
    fixed=STRING,
    cve=STRING,
    cwe=STRINGS,
    package_file=STRING,
)


def _scan(count_field: str, items_field: str, item: T.StructType) -> T.StructType:
    """Envelope shared by both scanners. scan_duration is in nanoseconds."""
    return record(
        org=STRING,
        name=STRING,
        processed_at=TIME,
        scanned_at=TIME,
        worker_id=INT,
        **{count_field: INT, items_field: T.ArrayType(item)},
        scan_status=STRING,
        scan_duration=LONG,
        error_message=STRING,
    )


SECRET_SCAN = _scan("valid_secrets_found", "valid_secrets", SECRET_FINDING)
VULNERABILITY_SCAN = _scan("vulnerabilities_found", "vulnerabilities", VULNERABILITY)

CLEANUP_JOB = record(
    clone_path=STRING, org=STRING, name=STRING, requested_at=TIME, worker_id=INT
)

COMPLETION_MESSAGE = record(
    clone_path=STRING,
    org=STRING,
    name=STRING,
    scanner_type=STRING,
    completed_at=TIME,
    worker_id=INT,
    scan_status=STRING,
    scan_duration=LONG,
)

SECRET_DOCUMENT = record(
    organization=STRING,
    repository=STRING,
    secret_type=STRING,
    description=STRING,
    file_path=STRING,
    line_number=INT,
    commit_hash=STRING,
    confidence=STRING,
    validated=BOOL,
    scanned_at=TIME,
    processed_at=TIME,
    scan_status=STRING,
    worker_id=INT,
)

INDEXED_VULNERABILITY = record(
    id=STRING,
    package=STRING,
    version=STRING,
    ecosystem=STRING,
    severity=STRING,
    summary=STRING,
    cve=STRING,
    cwe=STRINGS,
    package_file=STRING,
)

VULNERABILITY_DOCUMENT = record(
    organization=STRING,
    repository=STRING,
    vulnerability_count=INT,
    critical_count=INT,
    high_count=INT,
    medium_count=INT,
    low_count=INT,
    unknown_count=INT,
    scanned_at=TIME,
    processed_at=TIME,
    scan_status=STRING,
    scan_duration=LONG,
    worker_id=INT,
    error_message=STRING,
    vulnerabilities=T.ArrayType(INDEXED_VULNERABILITY),
)

RAW_SECRET = record(
    SourceMetadata=record(
        Data=record(
            Git=record(
                commit=STRING,
                file=STRING,
                email=STRING,
                repository=STRING,
                timestamp=STRING,
                line=INT,
            )
        )
    ),
    SourceID=INT,
    SourceType=INT,
    SourceName=STRING,
    DetectorType=INT,
    DetectorName=STRING,
    DecoderName=STRING,
    Verified=BOOL,
    Raw=STRING,
    RawV2=STRING,
    Redacted=STRING,
    ExtraData=T.MapType(STRING, STRING),
    StructuredData=T.VariantType(),
    VerificationError=STRING,
)

RAW_VULNERABILITY_REPORT = record(
    results=T.ArrayType(
        record(
            source=record(path=STRING, type=STRING),
            packages=T.ArrayType(
                record(
                    package=record(name=STRING, version=STRING, ecosystem=STRING),
                    vulnerabilities=T.ArrayType(
                        record(
                            id=STRING,
                            summary=STRING,
                            details=STRING,
                            aliases=STRINGS,
                            cwe=STRINGS,
                            severity=T.ArrayType(record(type=STRING, score=STRING)),
                        )
                    ),
                )
            ),
        )
    )
)

QUEUE_SAMPLE = record(queue=STRING, key_type=STRING, ts=TIME, length=LONG, items=STRINGS)
FOLDER_ENTRY = record(ts=TIME, path=STRING, is_dir=BOOL, size=LONG)

# Fixed wire values: fields left out of the JSON when empty (dotted = inside an array).
OMIT_EMPTY = {
    "secret_scan": ("error_message", "valid_secrets.service"),
    "vulnerability_scan": (
        "error_message",
        "vulnerabilities.fixed",
        "vulnerabilities.cve",
        "vulnerabilities.cwe",
    ),
    "vulnerability_document": (
        "error_message",
        "vulnerabilities.cve",
        "vulnerabilities.cwe",
    ),
}

# Fixed wire values: the two scanner names a completion message may carry.
SECRET_SCANNER = "scanner-trufflehog"
VULNERABILITY_SCANNER = "scanner-osv"
SCANNERS = (SECRET_SCANNER, VULNERABILITY_SCANNER)
