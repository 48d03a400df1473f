"""Queries over findings, scalar functions and index documents."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake import schemas
from scanlake.functions import labels, nested, paths
from scanlake.functions.secrets import DEFAULT_RULES, find_secrets
from scanlake.operators import documents as docs
from scanlake.operators import findings as ops
from scanlake.operators.version_ranges import match_versions_by_place
from scanlake.plans.query import Registry
from scanlake.sources.records import decode_records, encode_records
from scanlake.sources.tables import table

FINDINGS = Registry()


def first_of(count: Column, *items: Column) -> Column:
    """The first ``count`` of the items as an array."""
    return F.slice(F.array(*items), F.lit(1), count)


def text_of(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


# ---------------------------------------------------------------- scanner output


@FINDINGS.add(
    "secret_findings",
    """
    WITH l AS (SELECT *, CASE l_returnflag WHEN 'R' THEN 'AWS' WHEN 'A' THEN 'GitHub' ELSE 'Slack' END AS kind FROM lineitem)
    SELECT l_orderkey, l_partkey, 2 AS line_no, kind AS secret_type, 'Found ' || kind || ' secret' AS description,
           'src/' || l_suppkey || '.yml' AS file, l_linenumber AS line, md5(CAST(l_partkey AS VARCHAR)) AS "commit",
           'high' AS confidence, l_linestatus = 'O' AS validated,
           CASE WHEN l_discount > 0.05 THEN 'verification_error: invalid token' ELSE '' END AS service
    FROM l
    UNION ALL
    SELECT l_orderkey, l_partkey, 4, 'Plain', 'Found Plain secret', '', 0, '', 'high', false, '' FROM l
    """,
)
def secret_findings(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "R", "AWS").when(F.col("l_returnflag") == "A", "GitHub").otherwise("Slack")
    git = F.struct(
        F.md5(F.col("l_partkey").cast("string")).alias("commit"),
        text_of("src/", F.col("l_suppkey"), ".yml").alias("file"),
        F.col("l_linenumber").alias("line"),
    )
    line = F.to_json(
        F.struct(
            F.struct(F.struct(git.alias("Git")).alias("Data")).alias("SourceMetadata"),
            kind.alias("DetectorName"),
            (F.col("l_linestatus") == "O").alias("Verified"),
            F.when(F.col("l_discount") > 0.05, "invalid token").alias("VerificationError"),
        )
    )
    broken = F.when(F.col("l_partkey") % 10 == 0, "{invalid json}").otherwise("")
    output = text_of(broken, "\n", line, '\n\n{"DetectorName":"Plain"}')
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", output.alias("value"))
    return ops.parse_secret_lines(rows, keep=["l_orderkey", "l_partkey"])


def reports(spark: SparkSession, sf: str) -> DataFrame:
    """One report per line item: one source, 1-2 packages, 0-2 vulnerabilities each."""

    part, flag = F.col("l_partkey").cast("string"), F.col("l_returnflag")
    score = F.when(F.col("l_linenumber") > 5, "Critical").when(flag == "A", "low").when(flag == "R", "7.4")
    rows = table(spark, sf, "lineitem").withColumns(
        {
            "_package": text_of("part", part),
            "_id": text_of("V-", part, "-"),
            "_aliases": F.array(F.lit("CVE"), text_of("GHSA-", part), text_of("CVE-", part)),
            "_scores": F.array(F.struct(F.lit("CVSS_V3").alias("type"), score.alias("score"))),
            "_version": F.concat(F.col("l_linenumber").cast("string"), F.lit(".")),
            "_path": text_of("app/", F.col("l_suppkey"), ".json"),
        }
    )

    def vulnerability(p: int, v: int) -> Column:
        aliases = F.col("_aliases") if v == 1 else F.array().cast("array<string>")
        return F.struct(
            F.concat("_id", F.lit(f"{p}-{v}")).alias("id"),
            F.lit(f"summary {v}").alias("summary"),
            F.lit("details").alias("details"),
            aliases.alias("aliases"),
            F.array(F.lit(f"CWE-{v}")).alias("cwe"),
            F.col("_scores").alias("severity"),
        )

    def package(p: int) -> Column:
        return F.struct(
            F.struct(
                F.col("_package").alias("name"),
                F.concat("_version", F.lit(str(p))).alias("version"),
                F.lit("npm").alias("ecosystem"),
            ).alias("package"),
            first_of(F.col("l_linenumber") % 3, vulnerability(p, 1), vulnerability(p, 2)).alias("vulnerabilities"),
        )

    source = F.struct(F.col("_path").alias("path"), F.lit("lockfile").alias("type"))
    packages = first_of(F.col("l_linenumber") % 2 + 1, package(1), package(2))
    return rows.withColumn("results", F.array(F.struct(source.alias("source"), packages.alias("packages"))))


@FINDINGS.add(
    "flatten_vulnerabilities",
    """
    SELECT l_orderkey, 0 AS result_no, CAST(p - 1 AS INTEGER) AS package_no, CAST(v - 1 AS INTEGER) AS vulnerability_no,
           'V-' || l_partkey || '-' || p || '-' || v AS id, 'part' || l_partkey AS package,
           l_linenumber || '.' || p AS version, 'npm' AS ecosystem,
           CASE WHEN l_linenumber > 5 THEN 'Critical' WHEN l_returnflag = 'A' THEN 'low'
                WHEN l_returnflag = 'R' THEN '7.4' ELSE '' END AS severity,
           'summary ' || v AS summary, 'details' AS details,
           CASE WHEN v = 1 THEN 'CVE-' || l_partkey ELSE '' END AS cve,
           'CWE-' || v AS cwe, 'app/' || l_suppkey || '.json' AS package_file
    FROM lineitem, generate_series(1, 2) AS ps(p), generate_series(1, 2) AS vs(v)
    WHERE p <= l_linenumber % 2 + 1 AND v <= l_linenumber % 3
    """,
)
def flattened(spark: SparkSession, sf: str) -> DataFrame:
    rows = ops.flatten_vulnerabilities(reports(spark, sf), keep=["l_orderkey"])
    return rows.drop("aliases", "fixed").withColumn("cwe", F.array_join("cwe", ","))


@FINDINGS.add(
    "first_cve",
    """
    SELECT p_partkey,
           CASE WHEN p_size % 4 = 0 THEN '' WHEN p_size % 4 = 3 THEN 'CVEX' ELSE 'CVE-' || p_partkey END AS cve,
           CASE WHEN p_size % 3 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS severity
    FROM part
    """,
)
def cves(spark: SparkSession, sf: str) -> DataFrame:
    size, cve = F.col("p_size"), text_of("CVE-", F.col("p_partkey"))
    aliases = (
        F.when(size % 4 == 0, F.array(F.col("p_name"), F.lit("CVE"), F.lit("cve-1")))
        .when(size % 4 == 1, F.array(cve, F.lit("CVE-0")))
        .when(size % 4 == 2, F.array(F.col("p_brand"), F.lit("CVE"), cve))
        .otherwise(F.array(F.lit("CVEX"), cve))
    )
    score = F.struct(size.cast("string").alias("score"))
    scores = F.when(size % 3 != 0, F.array(score, F.struct(F.lit("0").alias("score"))))
    return table(spark, sf, "part").select(
        "p_partkey", nested.first_cve(aliases).alias("cve"), nested.first_severity(scores).alias("severity")
    )


@FINDINGS.add(
    "scan_status",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'timeout' WHEN o_orderstatus = 'F' THEN 'failed'
                WHEN o_custkey % 3 = 0 THEN 'no_secrets' ELSE 'success' END AS secrets_status,
           CASE WHEN o_orderstatus = 'F' THEN 'failed'
                WHEN o_custkey % 3 = 0 THEN 'no_vulnerabilities' ELSE 'success' END AS vulnerabilities_status
    FROM orders
    """,
)
def statuses(spark: SparkSession, sf: str) -> DataFrame:
    count, error = F.col("o_custkey") % 3, F.when(F.col("o_orderstatus") == "F", "scan failed")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        nested.scan_status("secrets", count, error, F.col("o_orderpriority") == "1-URGENT").alias("secrets_status"),
        nested.scan_status("vulnerabilities", count, error).alias("vulnerabilities_status"),
    )


# ---------------------------------------------------------------- secret detection

RULE_SELECTS = "\n    UNION ALL ".join(
    f"""SELECT doc_id, line, {no} AS rule_no, '{rule.name}' AS secret_type, unnest(found) AS match, generate_subscripts(found, 1) AS n
        FROM (SELECT doc_id, line, regexp_extract_all(body, '{rule.pattern.replace("'", "''")}', {rule.group}) AS found FROM l)"""
    for no, rule in enumerate(DEFAULT_RULES)
)

DETECT_SQL = f"""
    WITH split AS (SELECT doc_id, string_split("text", chr(10)) AS lines FROM documents),
    l AS (SELECT doc_id, unnest(lines) AS body, CAST(generate_subscripts(lines, 1) AS INTEGER) AS line FROM split),
    hits AS ({RULE_SELECTS})
    SELECT doc_id,
           CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line, rule_no, n) - 1 AS INTEGER) AS finding_no,
           line, secret_type, match, left(match, 4) || repeat('*', length(match) - 4) AS redacted
    FROM hits
"""


PLANTED_SQL = """
    SELECT doc_id, CAST(len(string_split("text", chr(10))) + 1 AS INTEGER) AS line, kind AS secret_type, secret AS match
    FROM (SELECT doc_id, "text", unnest(['AWS', 'GitHub', 'Slack', 'PrivateKey', 'JWT', 'URI', 'Token']) AS kind,
                 unnest(['AKIA' || lpad(doc_id::VARCHAR, 16, '0'), 'ghp_' || lpad(doc_id::VARCHAR, 36, 'a'),
                         'xoxb-' || lpad(doc_id::VARCHAR, 200, '7'), '-----BEGIN RSA 2 PRIVATE KEY-----',
                         'eyJ' || lpad(doc_id::VARCHAR, 90, 'b') || '.eyJ45678901.' || repeat('z', 80), 'pw' || doc_id,
                         lpad(doc_id::VARCHAR, 80, '0')]) AS secret,
                 generate_subscripts([0, 1, 2, 3, 4, 5, 6], 1) - 1 AS no FROM documents)
    WHERE no = doc_id % 9
"""


@FINDINGS.add("detect_secrets_rules", PLANTED_SQL)
def planted(spark: SparkSession, sf: str) -> DataFrame:
    """One value of a rule after each text; of nine texts, two get runs that are too long for a key."""
    doc = F.col("doc_id").cast("string")
    values = [
        text_of("key AKIA", F.lpad(doc, 16, "0"), " end"),
        text_of("ghp_", F.lpad(doc, 36, "a")),
        text_of("(xoxb-", F.lpad(doc, 200, "7"), ")"),
        text_of("-----BEGIN RSA 2 PRIVATE KEY-----"),
        text_of("jwt=eyJ", F.lpad(doc, 90, "b"), ".eyJ45678901.", "z" * 80),
        text_of("at db+x://user:pw", doc, "@host/p and http://host/plain"),
        text_of('Api_Key : "', F.lpad(doc, 80, "0"), '"'),
        text_of("AKIA", F.lpad(doc, 17, "0")),
        text_of("ghp_", F.lpad(doc, 40, "a")),
    ]
    value = F.element_at(F.array(*values), (F.col("doc_id") % 9 + 1).cast("int"))
    texts = table(spark, sf, "documents").select(
        "doc_id", F.size(F.split("text", "\n")).alias("lines"), text_of(F.col("text"), "\n", value).alias("text")
    )
    found = ops.detect_secrets(texts, keep=["doc_id", "lines"])
    return found.filter(F.col("line") > F.col("lines")).select("doc_id", "line", "secret_type", "match")


@FINDINGS.add("detect_secrets", DETECT_SQL)
def detected(spark: SparkSession, sf: str) -> DataFrame:
    return ops.detect_secrets(table(spark, sf, "documents")).drop("validated")


@FINDINGS.add(
    "detect_secrets_verified",
    f"""
    WITH f AS ({DETECT_SQL})
    SELECT f.doc_id, f.line, f.secret_type, f.redacted FROM f
    WHERE match IN (SELECT match FROM f WHERE doc_id % 2 = 0)
    """,
)
def verified(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "documents")
    known = ops.detect_secrets(texts.filter("doc_id % 2 = 0")).select(F.sha2("match", 256).alias("match_hash"))
    found = ops.detect_secrets(texts, verified=known, only_verified=True)
    return found.select("doc_id", "line", "secret_type", "redacted")


@FINDINGS.add(
    "document_secrets",
    f"""
    WITH f AS ({DETECT_SQL}),
    d AS (SELECT documents.doc_id, source, lang, doc_id % 97 = 0 AS failed, f.*
          FROM documents LEFT JOIN f USING (doc_id))
    SELECT CASE WHEN match IS NULL OR failed
                THEN source || '_doc' || doc_id || '_summary_' || (1704067200 + doc_id)
                ELSE source || '_doc' || doc_id || '_' || md5(lang) || '_' || line || '_' || finding_no END AS id,
           source AS organization, 'doc' || doc_id AS repository,
           CASE WHEN match IS NULL OR failed THEN 'NO_SECRETS_FOUND' ELSE secret_type END AS secret_type,
           CASE WHEN match IS NULL OR failed THEN 'No secrets found in repository'
                ELSE 'Found ' || secret_type || ' secret' END AS description,
           CASE WHEN match IS NULL OR failed THEN 0 ELSE line END AS line_number,
           CASE WHEN match IS NULL OR failed THEN '' ELSE 'high' END AS confidence,
           CASE WHEN failed THEN 'failed' WHEN match IS NULL THEN 'no_secrets' ELSE 'success' END AS scan_status
    FROM d WHERE NOT failed OR coalesce(finding_no, 0) = 0
    """,
)
def document_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """Texts to index documents in one pass: detect, build scan records, write documents."""
    doc = F.col("doc_id")
    scans = table(spark, sf, "documents").select(
        F.col("source").alias("org"),
        text_of("doc", doc).alias("name"),
        F.timestamp_seconds(doc + 1704060000).alias("processed_at"),
        F.timestamp_seconds(doc + 1704067200).alias("scanned_at"),
        F.lit(1).alias("worker_id"),
        (F.col("n_chars") * 1000).alias("scan_duration"),
        "text", "lang", "doc_id",
    )
    found = F.transform(
        find_secrets(F.col("text")),
        lambda f: F.struct(
            f["secret_type"],
            text_of("Found ", f["secret_type"], " secret").alias("description"),
            text_of("doc", doc, ".txt").alias("file"),
            f["line"],
            F.md5("lang").alias("commit"),
            F.lit("high").alias("confidence"),
            F.lit(False).alias("validated"),
            F.lit("").alias("service"),
        ),
    )
    records = ops.scan_records(scans, "secrets", found, F.when(doc % 97 == 0, "scan failed"))
    return docs.secret_documents(records).select(
        "id", "organization", "repository", "secret_type", "description", "line_number", "confidence", "scan_status"
    )


# ---------------------------------------------------------------- index documents


def secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    """One scan per line item with 0-3 findings."""

    def finding(k: int) -> Column:
        return F.struct(
            text_of("T", F.col("l_returnflag"), k).alias("secret_type"),
            text_of("Found ", k).alias("description"),
            text_of("f", F.col("l_suppkey")).alias("file"),
            (F.col("l_linenumber") + k * 10).alias("line"),
            F.md5(F.col("l_partkey").cast("string")).alias("commit"),
            F.lit("high").alias("confidence"),
            F.lit(k % 2 == 1).alias("validated"),
            F.lit("dropped").alias("service"),
        )

    findings = first_of(F.col("l_linenumber") % 4, finding(1), finding(2), finding(3))
    scans = table(spark, sf, "lineitem").select(
        text_of("org", F.col("l_suppkey")).alias("org"),
        text_of("repo", F.col("l_partkey")).alias("name"),
        F.col("l_shipdate").cast("timestamp").alias("processed_at"),
        F.col("l_shipdate").cast("timestamp").alias("scanned_at"),
        F.col("l_linenumber").alias("worker_id"),
        F.lit(5_000_000_000).alias("scan_duration"),
        findings.alias("_findings"),
    )
    return ops.scan_records(scans, "secrets", F.col("_findings"))


@FINDINGS.add(
    "secret_documents",
    """
    WITH l AS (SELECT *, 'org' || l_suppkey AS org, 'repo' || l_partkey AS repo,
                      strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM lineitem)
    SELECT 'secrets' AS "index", org || '_' || repo || '_' || md5(CAST(l_partkey AS VARCHAR)) || '_' || (k * 10 + l_linenumber) || '_' || (k - 1) AS id,
           org AS organization, repo AS repository, 'T' || l_returnflag || k AS secret_type, 'Found ' || k AS description,
           'f' || l_suppkey AS file_path, CAST(k * 10 + l_linenumber AS INTEGER) AS line_number,
           md5(CAST(l_partkey AS VARCHAR)) AS commit_hash, 'high' AS confidence, k % 2 = 1 AS validated,
           stamp AS scanned_at, stamp AS processed_at, 'success' AS scan_status, l_linenumber AS worker_id
    FROM l, generate_series(1, 3) AS ks(k) WHERE k <= l_linenumber % 4
    UNION ALL
    SELECT 'secrets', org || '_' || repo || '_summary_' || CAST(epoch(l_shipdate) AS BIGINT), org, repo,
           'NO_SECRETS_FOUND', 'No secrets found in repository', '', 0, '', '', false, stamp, stamp, 'no_secrets', l_linenumber
    FROM l WHERE l_linenumber % 4 = 0
    """,
)
def secret_documents(spark: SparkSession, sf: str) -> DataFrame:
    rows = docs.secret_documents(secret_scans(spark, sf))
    return rows.withColumns({c: labels.rfc3339(F.col(c)) for c in ("scanned_at", "processed_at")})


@FINDINGS.add(
    "scan_to_documents",
    """
    WITH o AS (SELECT *, 'c' || o_custkey AS org, 'r' || o_orderkey AS repo, o_orderkey % 3 = 0 AS none FROM orders)
    SELECT CASE WHEN none THEN org || '_' || repo || '_summary_' || CAST(epoch(o_orderdate) AS BIGINT)
                ELSE org || '_' || repo || '_' || md5(CAST(o_custkey AS VARCHAR)) || '_' || (o_orderkey % 100) || '_0' END AS id,
           org AS organization, repo AS repository,
           CASE WHEN none THEN 'NO_SECRETS_FOUND' ELSE o_orderpriority END AS secret_type,
           CASE WHEN none THEN 0 ELSE CAST(o_orderkey % 100 AS INTEGER) END AS line_number,
           NOT none AND o_orderstatus = 'F' AS validated,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS scanned_at,
           CASE WHEN none THEN 'no_secrets' ELSE 'success' END AS scan_status
    FROM o
    """,
)
def scan_to_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Scanner output to scan record, over the wire as JSON, to index documents; no shuffle."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    git = F.struct(
        F.md5(customer.cast("string")).alias("commit"), F.lit("a.env").alias("file"), (order % 100).alias("line")
    )
    line = F.to_json(
        F.struct(
            F.struct(F.struct(git.alias("Git")).alias("Data")).alias("SourceMetadata"),
            F.col("o_orderpriority").alias("DetectorName"),
            (F.col("o_orderstatus") == "F").alias("Verified"),
        )
    )
    scans = table(spark, sf, "orders").select(
        text_of("c", customer).alias("org"),
        text_of("r", order).alias("name"),
        F.col("o_orderdate").cast("timestamp").alias("processed_at"),
        F.col("o_orderdate").cast("timestamp").alias("scanned_at"),
        F.lit(2).alias("worker_id"),
        F.lit(60_000_000_000).alias("scan_duration"),
        F.when(order % 3 == 0, "\n{broken\n").otherwise(line).alias("_output"),
    )
    records = ops.scan_records(scans, "secrets", ops.secret_array(F.col("_output")))
    queued = encode_records(records, schemas.OMIT_EMPTY["secret_scan"])
    rows = docs.secret_documents(decode_records(queued, schemas.SECRET_SCAN))
    return rows.select(
        "id", "organization", "repository", "secret_type", "line_number", "validated",
        labels.rfc3339(F.col("scanned_at")).alias("scanned_at"), "scan_status",
    )


@FINDINGS.add(
    "document_ids",
    """
    SELECT o_orderkey,
           'c' || o_custkey || '_r' || o_orderkey || '_' || o_orderstatus || '_' || (o_orderkey % 100) || '_' || (o_orderkey % 7) AS finding_id,
           'c' || o_custkey || '_r' || o_orderkey || '_summary_' || CAST(epoch(o_orderdate) AS BIGINT) AS summary_id,
           'c' || o_custkey || '_r' || o_orderkey || '_osv_' || CAST(epoch(o_orderdate) AS BIGINT) AS vulnerability_id
    FROM orders
    """,
)
def document_ids(spark: SparkSession, sf: str) -> DataFrame:
    org, name = text_of("c", F.col("o_custkey")), text_of("r", F.col("o_orderkey"))
    key, at = F.col("o_orderkey"), F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        paths.finding_id(org, name, F.col("o_orderstatus"), key % 100, key % 7).alias("finding_id"),
        paths.summary_id(org, name, at).alias("summary_id"),
        paths.vulnerability_id(org, name, at).alias("vulnerability_id"),
    )


@FINDINGS.add(
    "vulnerability_documents",
    """
    WITH l AS (SELECT *, (l_linenumber % 2 + 1) * (l_linenumber % 3) AS n, 'org' || l_suppkey AS org, 'repo' || l_partkey AS repo FROM lineitem)
    SELECT org || '_' || repo || '_osv_' || CAST(epoch(l_shipdate) AS BIGINT) AS id, org AS organization, repo AS repository,
           CAST(n AS INTEGER) AS vulnerability_count,
           CAST(CASE WHEN l_linenumber > 5 THEN n ELSE 0 END AS INTEGER) AS critical_count,
           CAST(CASE WHEN l_linenumber <= 5 AND l_returnflag = 'A' THEN n ELSE 0 END AS INTEGER) AS low_count,
           CAST(CASE WHEN l_linenumber <= 5 AND l_returnflag <> 'A' THEN n ELSE 0 END AS INTEGER) AS unknown_count,
           CASE WHEN n = 0 THEN 'no_vulnerabilities' ELSE 'success' END AS scan_status,
           coalesce((SELECT string_agg('V-' || l_partkey || '-' || p || '-' || v || ' CWE-' || v, ',' ORDER BY p, v)
            FROM generate_series(1, 2) AS ps(p), generate_series(1, 2) AS vs(v)
            WHERE p <= l_linenumber % 2 + 1 AND v <= l_linenumber % 3), '') AS listed
    FROM l
    """,
)
def vulnerability_documents(spark: SparkSession, sf: str) -> DataFrame:
    scans = reports(spark, sf).select(
        text_of("org", F.col("l_suppkey")).alias("org"),
        text_of("repo", F.col("l_partkey")).alias("name"),
        F.col("l_shipdate").cast("timestamp").alias("processed_at"),
        F.col("l_shipdate").cast("timestamp").alias("scanned_at"),
        F.col("l_linenumber").alias("worker_id"),
        F.lit(5_000_000_000).alias("scan_duration"),
        ops.vulnerability_array(F.col("results")).alias("_found"),
    )
    rows = docs.vulnerability_documents(ops.scan_records(scans, "vulnerabilities", F.col("_found")))
    listed = F.array_join(
        F.transform("vulnerabilities", lambda v: F.concat_ws(" ", v["id"], F.array_join(v["cwe"], "/"))), ","
    )
    return rows.select(
        "id", "organization", "repository", "vulnerability_count", "critical_count", "low_count",
        "unknown_count", "scan_status", listed.alias("listed"),
    )


@FINDINGS.add(
    "severity_counts",
    """
    SELECT o_custkey, count(*) FILTER (p = 'URGENT') AS critical_count, count(*) FILTER (p = 'HIGH') AS high_count,
           count(*) FILTER (p = 'MEDIUM') AS medium_count, count(*) FILTER (p = 'LOW') AS low_count,
           count(*) FILTER (p = 'NOT SPECIFIED') AS unknown_count
    FROM (SELECT o_custkey, substr(o_orderpriority, 3) AS p FROM orders) GROUP BY o_custkey
    """,
)
def severity_rollup(spark: SparkSession, sf: str) -> DataFrame:
    word = F.expr("substring(o_orderpriority, 3)")
    rows = table(spark, sf, "orders").select(
        "o_custkey", F.when(word == "URGENT", "Critical").otherwise(word).alias("severity")
    )
    return docs.severity_rollup(rows, ["o_custkey"])


# ---------------------------------------------------------------- paths and labels


@FINDINGS.add(
    "work_path",
    """SELECT s_suppkey, '/shared/repos/nation' || s_nationkey || '_' || s_name || '_' AS stem, 32 AS suffix_length, true AS is_hex
       FROM supplier""",
)
def work_paths(spark: SparkSession, sf: str) -> DataFrame:
    path = paths.work_path("/shared//repos/", text_of("nation", F.col("s_nationkey")), F.col("s_name"))
    rows = table(spark, sf, "supplier").select("s_suppkey", path.alias("path"))
    tail = F.substring_index("path", "_", -1)
    return rows.select(
        "s_suppkey",
        F.expr("left(path, length(path) - 32)").alias("stem"),
        F.length(tail).alias("suffix_length"),
        F.rlike(tail, F.lit("^[0-9a-f]{32}$")).alias("is_hex"),
    )


@FINDINGS.add(
    "repo_url",
    """SELECT s_suppkey, 'https://github.com/' || n_name || '/' || s_name || '.git' AS url
       FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def urls(spark: SparkSession, sf: str) -> DataFrame:
    owners = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return owners.select("s_suppkey", paths.repo_url(F.col("n_name"), F.col("s_name")).alias("url"))


@FINDINGS.add(
    "path_is_within",
    """
    WITH p AS (SELECT page_id, page_id % 5 AS k, regexp_extract(url, '^https?://[^/]+/*(.*?)/*$', 1) AS tail FROM pages)
    SELECT page_id,
           CASE k WHEN 0 THEN '/shared/' WHEN 1 THEN '/' WHEN 2 THEN '/shared-evil/' WHEN 3 THEN '/work/shared/' ELSE '/' END || tail AS cleaned,
           k = 0 AS within, k IN (0, 2) AS has_prefix
    FROM p
    """,
)
def contained(spark: SparkSession, sf: str) -> DataFrame:
    tail = F.regexp_extract("url", "^https?://[^/]+(/.*)?$", 1)
    k = F.col("page_id") % 5
    path = (
        F.when(k == 0, text_of("/shared//./", tail))
        .when(k == 1, text_of("/shared/../", tail))
        .when(k == 2, text_of("/shared-evil", tail))
        .when(k == 3, text_of("./shared/x/..", tail))
        .otherwise(text_of("/shared/a/../../../..", tail))
    )
    rows = table(spark, sf, "pages").select("page_id", path.alias("path"))
    return rows.select(
        "page_id",
        paths.absolute_path(F.col("path"), "/work").alias("cleaned"),
        paths.path_is_within(F.col("path"), "/shared", "/work").alias("within"),
        paths.path_is_within(F.col("path"), "/shared", "/work", prefix_only=True).alias("has_prefix"),
    )


def _bytes_sql(n: str) -> str:
    steps = " ".join(
        f"WHEN {n} < {1024 ** (p + 1)} THEN printf('%.1f {u}B', {n} / {1024 ** p}.0::DOUBLE)"
        for p, u in enumerate("KMGTP", start=1)
    )
    return f"CASE WHEN {n} < 1024 THEN {n} || ' B' {steps} END"


@FINDINGS.add(
    "format_bytes",
    f"""SELECT doc_id, {_bytes_sql('n_chars')} AS label, {_bytes_sql('(n_chars * 1000)')} AS large,
               {_bytes_sql('(n_chars * 123456789)')} AS huge FROM documents""",
)
def byte_labels(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("n_chars")
    return table(spark, sf, "documents").select(
        "doc_id",
        labels.format_bytes(size).alias("label"),
        labels.format_bytes(size * 1000).alias("large"),
        labels.format_bytes(size * 123456789).alias("huge"),
    )


@FINDINGS.add(
    "format_duration",
    """
    WITH s AS (SELECT o_orderkey, (o_orderkey * 987654321 + 500000000) // 1000000000 AS s FROM orders)
    SELECT o_orderkey, CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s // 60 % 60) || 'm ' || (s % 60) || 's'
                            WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE s || 's' END AS label
    FROM s
    """,
)
def duration_labels(spark: SparkSession, sf: str) -> DataFrame:
    label = labels.format_duration(F.col("o_orderkey") * 987654321).alias("label")
    return table(spark, sf, "orders").select("o_orderkey", label)


def _cut_sql(text: str, limit: int) -> str:
    head = f"list_max(list_filter(range(0, {limit - 2}), lambda n: strlen(left({text}, n)) <= {limit - 3}))"
    return f"CASE WHEN strlen({text}) > {limit} THEN left({text}, {head}) || '...' ELSE {text} END"


@FINDINGS.add(
    "item_label",
    f"""
    SELECT 'page' || page_id AS item,
           regexp_extract(url, '([^/]*/[^/]*)$', 1) AS label FROM pages
    UNION ALL SELECT 'doc' || doc_id, {_cut_sql('"text"', 50)} FROM documents
    UNION ALL SELECT 'event' || event_id,
           CASE event_id % 4 WHEN 0 THEN event_type || '/u' || user_id WHEN 1 THEN 'name: u' || user_id
                             WHEN 2 THEN event_type ELSE props END FROM events
    """,
)
def item_labels(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select(
        text_of("page", F.col("page_id")).alias("item"),
        F.to_json(F.struct(F.col("page_id"), F.col("url"))).alias("raw"),
    )
    texts = table(spark, sf, "documents").select(text_of("doc", F.col("doc_id")).alias("item"), F.col("text").alias("raw"))
    kind, user = F.col("event_id") % 4, text_of("u", F.col("user_id"))
    record = (
        F.when(kind == 0, text_of('{"name":"', user, '","org":"', F.col("event_type"), '"}'))
        .when(kind == 1, text_of('{"name":"', user, '","org":5,"z":"last"}'))
        .when(kind == 2, text_of('{"url":"a/b","repository":"', F.col("event_type"), '"}'))
        .otherwise(F.col("props"))
    )
    events = table(spark, sf, "events").select(text_of("event", F.col("event_id")).alias("item"), record.alias("raw"))
    rows = pages.unionByName(texts).unionByName(events)
    return rows.select("item", labels.item_label(F.col("raw")).alias("label"))


@FINDINGS.add(
    "parse_info",
    """
    WITH s AS (SELECT doc_id, string_split("text" || e'\\nlang:x\\r\\n lang : ' || lang || ':' || source || e'\\t\\n:none', chr(10)) AS lines FROM documents),
    l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM s),
    e AS (SELECT doc_id, pos, trim(left(line, instr(line, ':') - 1), e' \\t\\r\\n\\v\\f') AS key,
                 trim(substr(line, instr(line, ':') + 1), e' \\t\\r\\n\\v\\f') AS value
          FROM l WHERE instr(line, ':') > 0)
    SELECT doc_id, key, value FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, key ORDER BY pos DESC) AS rn FROM e) WHERE rn = 1
    """,
)
def info_entries(spark: SparkSession, sf: str) -> DataFrame:
    text = text_of(F.col("text"), "\nlang:x\r\n lang : ", F.col("lang"), ":", F.col("source"), "\t\n:none")
    rows = table(spark, sf, "documents").select("doc_id", labels.parse_info(text).alias("info"))
    return rows.select("doc_id", F.explode("info").alias("key", "value"))


@FINDINGS.add(
    "ellipsize",
    f"""SELECT doc_id, {_cut_sql('"text"', 25)} AS item, {_cut_sql("(source || ' has ' || n_chars || ' repositories')", 20)} AS details
        FROM documents""",
)
def cut_labels(spark: SparkSession, sf: str) -> DataFrame:
    details = text_of(F.col("source"), " has ", F.col("n_chars"), " repositories")
    return table(spark, sf, "documents").select(
        "doc_id",
        labels.ellipsize(F.col("text"), 25).alias("item"),
        labels.ellipsize(details, 20).alias("details"),
    )


@FINDINGS.add(
    "signed_rate",
    """
    SELECT l_orderkey, l_partkey, CASE WHEN r = 0 THEN '0.0' ELSE printf('%+.1f', r) END AS rate,
           CASE WHEN q = 0 THEN '0.0' ELSE printf('%+.1f', q) END || ' MB/m' AS growth
    FROM (SELECT *, (l_extendedprice - 52000) / l_quantity AS r, (l_linenumber - 4) * l_discount * 5 AS q FROM lineitem)
    """,
)
def rate_labels(spark: SparkSession, sf: str) -> DataFrame:
    rate = (F.col("l_extendedprice") - 52000) / F.col("l_quantity")
    growth = (F.col("l_linenumber") - 4) * F.col("l_discount") * 5
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        labels.signed_rate(rate).alias("rate"),
        labels.signed_rate(growth, " MB/m").alias("growth"),
    )


# ---------------------------------------------------------------- dependency matches


_DEPS_SQL = """
    SELECT l_orderkey, l_partkey, l_orderkey % 5 AS form, [l_linenumber, CAST(l_quantity AS INTEGER)] AS v,
           'eco' || (l_partkey % 3) AS ecosystem, 'part' || l_partkey AS package,
           CASE WHEN l_orderkey % 11 = 0 THEN 'build ' || l_linenumber
                ELSE l_linenumber || '.' || CAST(l_quantity AS INTEGER) || '.0'
                     || ['', '-rc.' || l_linenumber, '+b.7', '.post1', 'a2'][l_orderkey % 5 + 1] END AS version
    FROM lineitem
"""


def dependencies(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as dependencies: releases, pre-releases, builds, post releases and texts that are no version."""
    line = F.col("l_linenumber")
    suffixes = F.array(F.lit(""), text_of("-rc.", line), F.lit("+b.7"), F.lit(".post1"), F.lit("a2"))
    version = text_of(line, ".", F.col("l_quantity").cast("int"), ".0", F.element_at(suffixes, (F.col("l_orderkey") % 5 + 1).cast("int")))
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        text_of("eco", F.col("l_partkey") % 3).alias("ecosystem"),
        text_of("part", F.col("l_partkey")).alias("package"),
        F.when(F.col("l_orderkey") % 11 == 0, text_of("build ", line)).otherwise(version).alias("version"),
    )


@FINDINGS.add(
    "unread_versions", f"SELECT l_orderkey, package, version FROM ({_DEPS_SQL}) WHERE l_orderkey % 11 = 0"
)
def unread(spark: SparkSession, sf: str) -> DataFrame:
    return ops.unread_versions(dependencies(spark, sf)).select("l_orderkey", "package", "version")


# Forms 1 and 4 come before their release, form 3 after it; the bounds are releases, or all versions for k = 1.
@FINDINGS.add(
    "match_vulnerabilities",
    f"""
    WITH deps AS ({_DEPS_SQL}),
    adv AS (SELECT 'eco' || (p_partkey % 3) AS ecosystem, 'part' || p_partkey AS package, 'ADV-' || p_partkey || '-' || k AS advisory,
                   k, p_size, [k, p_size] AS low, [k + 2, p_size] AS high
            FROM part, generate_series(1, 3) AS ks(k))
    SELECT l_orderkey, d.ecosystem, d.package, d.version, advisory
    FROM deps d JOIN adv a ON d.ecosystem = a.ecosystem AND d.package = a.package
    WHERE l_orderkey % 11 <> 0
      AND (a.k = 1 OR CASE WHEN form IN (1, 4) THEN d.v > a.low ELSE d.v >= a.low END)
      AND (a.k = 3 OR CASE WHEN form IN (1, 4) THEN d.v <= a.high ELSE d.v < a.high END)
    """,
)
def matches(spark: SparkSession, sf: str) -> DataFrame:
    k, size = F.col("k"), F.col("p_size")
    advisories = (
        table(spark, sf, "part")
        .withColumn("k", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
        .select(
            text_of("eco", F.col("p_partkey") % 3).alias("ecosystem"),
            text_of("part", F.col("p_partkey")).alias("package"),
            text_of("ADV-", F.col("p_partkey"), "-", k).alias("advisory"),
            F.when(k == 1, "0").otherwise(text_of("v", k, ".", size)).alias("introduced"),
            F.when(k == 3, "").otherwise(text_of(k + 2, ".", size, ".0.0")).alias("fixed"),
        )
    )
    found = ops.match_vulnerabilities(dependencies(spark, sf), advisories)
    return found.select("l_orderkey", "ecosystem", "package", "version", "advisory")


# Every third order and the ranges of all parts belong to one package; each 200th range has no end, others hold six numbers.
@FINDINGS.add(
    "match_hot_package",
    """
    WITH deps AS (
        SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'hot' ELSE 'c' || o_custkey END AS package FROM orders
    ), adv AS (
        SELECT 'hot' AS package, 'A' || p_partkey AS advisory, p_partkey * 29 % 600000 AS low, p_partkey % 200 = 0 AS no_end FROM part
        UNION ALL SELECT 'c' || p_partkey, 'C' || p_partkey, p_partkey * 29 % 600000, false FROM part
    )
    SELECT o_orderkey, d.package, 'v1.' || o_orderkey AS version, advisory
    FROM deps d JOIN adv a ON d.package = a.package AND o_orderkey >= low AND (no_end OR o_orderkey < low + 6)
    """,
)
def hot_matches(spark: SparkSession, sf: str) -> DataFrame:
    order, part = F.col("o_orderkey"), F.col("p_partkey")
    deps = table(spark, sf, "orders").select(
        order, F.lit("eco").alias("ecosystem"),
        F.when(order % 3 == 0, "hot").otherwise(text_of("c", F.col("o_custkey"))).alias("package"), text_of("v1.", order).alias("version"),
    )
    low = part * 29 % 600000
    advisories = table(spark, sf, "part").select(
        F.lit("eco").alias("ecosystem"), text_of("1.", low).alias("introduced"),
        F.when(part % 200 == 0, "").otherwise(text_of("1.", low + 6)).alias("fixed"),
        F.explode(F.array(F.struct(F.lit("hot").alias("package"), text_of("A", part).alias("advisory")),
                          F.struct(text_of("c", part).alias("package"), text_of("C", part).alias("advisory")))).alias("a"),
    )
    ends = F.when(F.col("a.package") == "hot", F.col("fixed")).otherwise(F.concat(F.lit("1."), F.substring("introduced", 3, 20).cast("long") + 6))
    advisories = advisories.select("ecosystem", "a.*", "introduced", ends.alias("fixed"))
    found = match_versions_by_place(deps, advisories)
    return found.select("o_orderkey", "package", "version", "advisory")
