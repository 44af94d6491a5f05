"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of a text is addressed by the SHA-256 of its bytes (a blob).  The
ledger is a Parquet table of (blob, rule, version, spans): what each version
of each rule found in each blob.  A scan

1. addresses all rows,
2. keeps the (blob, rule, version) triples the ledger lacks, one row for each
   such blob,
3. scans only those texts and appends their findings, empty ones included,
4. joins the findings back to every row of the blob (AQE splits a crowded one).

Scanning the next version of a corpus with the same ledger reads only texts
never seen before; raising a rule's version scans all blobs again for that rule
alone.  Text moves once, by (blob, id), so copies of one blob meet in no task.

Matches are leftmost and non-overlapping per rule, offsets are code points with
an exclusive end.  Places come from the lengths of the pieces between matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from userflow.llm.common import pack, unpack
from userflow.session import materialize, shared_path


@dataclass(frozen=True)
class Rule:
    """``pattern`` (Java syntax; without the possessive ``*+`` also RE2); ``group``: the group whose length counts,
    at least ``least`` code points, else the match is dropped."""

    name: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1


#: The rules, in the order in which spans at one place are listed.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
    # A private key whole: its headers, its lines (of base64, 16 characters or more; also with the
    # separators of quoted strings) and, where there is one, the short last line with the end mark.
    Rule("pem", r"""-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"""
                r"""(?:[\x20\x09-\x0D\\"'+]*(?:Proc-Type|DEK-Info|Version|Comment|Hash): [^\x0A\x0D]*)*+"""
                r"""(?:[\x20\x09-\x0D\\"'+]*[A-Za-z0-9+/=]{16,})*+"""
                r"""(?:(?:[\x20\x09-\x0D\\"'+]*+[A-Za-z0-9+/=]*+){0,4}-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----)?""",
         1, version=2),
)
MASK = "[SECRET]"
#: Blobs and spans together up to which findings are broadcast (some 25 MB).
BROADCAST_ITEMS = 300_000

_SPANS = "array<struct<start: int, kind: int, end: int>>"
LEDGER_SCHEMA = f"blob string, rule string, version int, spans {_SPANS}"


def blob_id(text: Column) -> Column:
    """SHA-256 of the text's UTF-8 bytes (null: of the empty text)."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _search_pattern(rule: Rule) -> str:
    """For a class repeated to its end, the length bound may go into the
    pattern: runs are matched whole, so no shorter match hides a longer one."""
    if rule.group == 0 and rule.pattern.endswith("]+"):
        fixed = len(rule.pattern[: rule.pattern.rindex("[")])
        return f"{rule.pattern[:-1]}{{{max(1, rule.least - fixed)},}}"
    return rule.pattern


def _quote(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans_sql(text: str, rule: Rule, kind: int) -> str:
    """SQL for the spans of one rule in string column ``text`` (not null)."""
    p = _quote(_search_pattern(rule))
    group = f"regexp_extract_all({text}, {p}, {rule.group})"
    return f"""
    CASE WHEN {text} RLIKE {p} THEN
      filter(
        aggregate(
          arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), {group}),
          struct(0 as at, cast(array() as array<struct<start: int, kind: int, end: int, n: int>>) as found),
          (a, x) -> CASE WHEN x.`1` IS NULL THEN a ELSE struct(
            a.at + char_length(x.`0`) + char_length(x.`1`) as at,
            concat(a.found, array(struct(a.at + char_length(x.`0`) as start, {kind} as kind,
                                         a.at + char_length(x.`0`) + char_length(x.`1`) as end,
                                         char_length(x.`2`) as n))) as found) END,
          a -> a.found),
        s -> s.n >= {rule.least})
    ELSE cast(array() as array<struct<start: int, kind: int, end: int, n: int>>) END"""


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; an empty one where nothing is written yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    return spark.createDataFrame([], LEDGER_SCHEMA)


def update_ledger(rows: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger at ``path`` lacks of ``rows`` (blob, text, place: the
    row's id) and append it; returns the ledger."""
    spark = rows.sparkSession
    blobs = materialize(rows.groupBy("blob").agg(F.min("place").alias("place")))
    known = open_ledger(spark, path)
    missing = blobs.withColumn("rule", F.lit("")).limit(0)
    for r in rules:
        seen = known.where((F.col("rule") == r.name) & (F.col("version") == r.version)).select("blob")
        missing = missing.unionByName(blobs.join(seen, "blob", "left_anti").withColumn("rule", F.lit(r.name)))
    missing = materialize(missing.groupBy("blob", "place").agg(F.collect_set("rule").alias("wanted")))
    if missing.isEmpty():
        return known
    # One row of each blob is read, the one with the smallest id, and scanned by
    # every rule the blob lacks.
    to = missing.select(F.col("blob").alias("to_blob"), F.col("place").alias("to_place"), "wanted")
    texts = (rows.join(to, (F.col("blob") == F.col("to_blob")) & F.col("place").eqNullSafe(F.col("to_place")))
             .select("blob", "wanted", F.coalesce("text", F.lit("")).alias("text")))
    _findings(texts, rules).write.mode("append").parquet(path)
    return open_ledger(spark, path)


def _findings(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    narrow = "cast(transform(%s, s -> struct(s.start as start, s.kind as kind, s.end as end)) as " + _SPANS + ")"
    each = ", ".join(
        f"CASE WHEN array_contains(wanted, '{r.name}') THEN struct('{r.name}' as rule, {r.version} as version, "
        f"{narrow % spans_sql('text', r, kind)} as spans) END" for kind, r in enumerate(rules))
    return texts.select("blob", F.expr(f"inline(filter(array({each}), x -> x IS NOT NULL))"))


def blob_spans(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans): all spans of the given rule versions, by start, then kind;
    blobs without any are left out."""
    current = F.lit(False)
    for r in rules:
        current = current | ((F.col("rule") == r.name) & (F.col("version") == r.version))
    return (ledger.where(current & (F.size("spans") > 0)).groupBy("blob")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans")))


def scan(docs: DataFrame, ledger_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, spans) for every row, through the ledger at ``ledger_path``
    (default: a new one in the shared folder).

    Null texts are the empty text, which holds nothing; repeated rows and copies
    share a blob and are scanned once; an empty table scans nothing.  A blob
    belongs to no row in particular: an id may name several versions.  ``kind``
    in a span is the rule's place in ``rules``.  Other columns are not read.
    """
    spark = docs.sparkSession
    path = ledger_path or shared_path(spark, "ledger")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       blob_id(F.col(text_col)).alias("blob"))
    places = materialize(rows.select("doc_id", "blob"))
    ledger = update_ledger(rows.select("blob", "text", F.col("doc_id").alias("place")), path, rules)
    found = materialize(blob_spans(ledger, rules))
    return places.join(found, "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", F.expr(f"cast(array() as {_SPANS})")).alias("spans"))


def mask_sql(text: str, spans: str, mask: str = MASK) -> str:
    """SQL for ``text`` with every span (sorted by start; they may overlap)
    replaced by ``mask``."""
    return f"""
    aggregate({spans}, struct('' as done, 0 as at), (a, s) -> CASE
        WHEN s.start >= a.at THEN struct(
          concat(a.done, substring({text}, a.at + 1, s.start - a.at), '{mask}') as done, s.end as at)
        ELSE struct(a.done as done, greatest(a.at, s.end) as at) END,
      a -> concat(a.done, substring({text}, a.at + 1)))"""


def mask_secrets(docs: DataFrame, ledger_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 length_col: str | None = "n_chars", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret span replaced by :data:`MASK` in the text, and
    ``length_col`` (if there) set to the new length of changed texts.

    All rows and columns stay; rows without a finding are unchanged, so a null text
    stays null.  Repeated rows and rows without an id are masked alike; an empty
    table stays empty.
    """
    spark = docs.sparkSession
    path = ledger_path or shared_path(spark, "ledger")
    rows = pack(docs).select("_row", blob_id(F.col(f"_row.{text_col}")).alias("blob"))
    ledger = update_ledger(rows.select("blob", F.col(f"_row.{text_col}").alias("text"),
                                       F.col(f"_row.{id_col}").alias("place")), path, rules)
    found = materialize(blob_spans(ledger, rules))
    n = found.agg(F.count("*").alias("blobs"), F.coalesce(F.sum(F.size("spans")), F.lit(0)).alias("spans")).head()
    if n["blobs"] + n["spans"] <= BROADCAST_ITEMS:  # else the texts move to their findings
        found = F.broadcast(found)
    joined = rows.join(found, "blob", "left").withColumn("_text", F.expr(
        f"CASE WHEN spans IS NULL THEN _row.`{text_col}` ELSE {mask_sql(f'_row.`{text_col}`', 'spans')} END"))
    out = F.col("_row").withField(f"`{text_col}`", F.col("_text"))
    if length_col and length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withField(f"`{length_col}`", F.when(F.col("spans").isNull(), F.col(f"_row.{length_col}"))
                            .otherwise(F.char_length("_text").cast(kind)))
    return unpack(joined.select(out.alias("_row")))


def oracle_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL for the counts and span lists of the documents table."""
    def found(kind: int, r: Rule) -> str:
        p = "'" + _search_pattern(r).replace("*+", "*").replace("'", "''") + "'"
        return f"""
        SELECT rid, {kind} AS kind, unnest(list_transform(range(1, len(hits) + 1), lambda i:
                 {{'s': CAST(list_sum(list_transform(gaps[:i], lambda g: length(g)))
                      + coalesce(list_sum(list_transform(hits[:i - 1], lambda h: length(h))), 0) AS BIGINT),
                  'n': length(hits[i]), 'm': length(parts[i])}})) AS x
        FROM (SELECT rid, regexp_extract_all(t, {p}, 0) AS hits, string_split_regex(t, {p}) AS gaps,
                     regexp_extract_all(t, {p}, {r.group}) AS parts FROM d)"""
    names = ", ".join(f"'{r.name}'" for r in rules)
    least = " ".join(f"WHEN {k} THEN x.m >= {r.least}" for k, r in enumerate(rules))
    listed = "array_to_string(list_transform(list_sort(list({0})), lambda s: [%s][s.kind + 1] || ':' || s.s || ':' || s.e), ',')" % names
    one = "{'s': x.s, 'kind': kind, 'e': x.s + x.n}"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    spans AS (SELECT * FROM ({" UNION ALL ".join(found(k, r) for k, r in enumerate(rules))})
              WHERE CASE kind {least} END),
    listed AS (SELECT rid, count_if(kind = 0) AS n0, count_if(kind = 1) AS n1, count_if(kind = 2) AS n2,
                      {listed.format(one + ") FILTER (kind < 3")} AS base,
                      {listed.format(one)} AS spans
               FROM spans GROUP BY rid)
    SELECT doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access,
           CAST(coalesce(n2, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
           coalesce(spans, '') AS spans
    FROM d LEFT JOIN listed ON listed.rid = d.rid"""
