"""Secret scans over a ledger of content-addressed texts.

Every version of every text is a blob, named by its SHA-256. A scan looks only at blobs that the
ledger does not yet hold under the rule version, and findings go back to all rows that have the blob.
The ledger is a Parquet table at a path of the user's, partitioned by rule version, to which each scan
appends. All of it is built-in expressions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.common import shared_dir

#: The kinds in order, with their patterns, the group that must be long enough and its least length.
BASE_RULES: tuple[tuple[str, str, int, int], ...] = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: Kinds that this scan adds.
MORE_RULES: tuple[tuple[str, str, int, int], ...] = (
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20),
)
RULES = BASE_RULES + MORE_RULES
RULE_VERSION = "2024-1"

_SPANS = "array<struct<start:int,kind:int,end:int>>"
_LEDGER = f"blob string, spans {_SPANS}, rule_version string"


def _spans(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Spans of one kind: what lies between the matches says where each begins (in code points)."""
    if pattern.startswith("[0-9a-f]+"):  # nearly every word has such runs: ask for long ones only, which are the same, as a run is taken whole
        pattern = pattern[:-1] + f"{{{least},}}"
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    own = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    lengths = F.transform(F.arrays_zip(F.split(text, pattern).alias("gap"), whole.alias("hit"), own.alias("own")), lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), F.length(x["own"]).alias("own")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["hit"], F.lit(0))
        found = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["own"] >= least, F.concat(acc["out"], found)).otherwise(acc["out"]).alias("out"))

    return F.when(F.regexp_like(text, F.lit(pattern)), F.aggregate(lengths, zero, step, lambda a: a["out"])).otherwise(F.array().cast(_SPANS))


def scanned(blobs: DataFrame, rules=RULES) -> DataFrame:
    """blob and spans (sorted by start, then kind) of every row of blobs (blob, text)."""
    found = [_spans(F.col("text"), i, pattern, group, least) for i, (_, pattern, group, least) in enumerate(rules)]
    return blobs.select("blob", F.array_sort(F.concat(*found)).alias("spans"))


def address_of(text: Column) -> Column:
    """The SHA-256 of a text's UTF-8 bytes; a null text is the empty blob."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def address(docs: DataFrame) -> DataFrame:
    """doc_id, blob and text of every row of docs."""
    return docs.select(F.col("doc_id").cast("long"), address_of(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))


def extend_ledger(docs: DataFrame, ledger: DataFrame | None = None, version: str = RULE_VERSION, rules=RULES) -> DataFrame:
    """The new entries (blob, rule_version, spans) that docs need: each unseen pair of blob and rule version once.

    Copies of a text meet inside each task before the shuffle, so a text that many rows share travels
    once per task. Texts do travel: to look at a text costs more than ten times what moving it does, and without
    the exchange every copy would be looked at. Without a ledger every blob is unseen.
    """
    blobs = address(docs).select("blob", "text").dropDuplicates(["blob"])
    if ledger is not None:
        blobs = blobs.join(ledger.filter(F.col("rule_version") == version).select("blob"), "blob", "left_anti")
    return scanned(blobs, rules).select("blob", F.lit(version).alias("rule_version"), "spans")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The entries of the ledger at path; a pair of blob and rule version may stand twice, if two scans ran at a time."""
    return spark.read.schema(_LEDGER).parquet(path)


def new_ledger(spark: SparkSession, path: str | None = None) -> str:
    """Make an empty ledger at path, or at a new place in the shared folder; returns the path. What lies at path is kept."""
    path = path or f"{shared_dir(spark)}/secret-ledger-{uuid.uuid4().hex}"
    spark.createDataFrame([], _LEDGER).write.mode("append").partitionBy("rule_version").parquet(path)
    return path


def scan(docs: DataFrame, path: str, version: str = RULE_VERSION, rules=RULES) -> None:
    """Append to the ledger at path what docs need and it lacks."""
    spark = docs.sparkSession
    extend_ledger(docs, read_ledger(spark, path), version, rules).write.mode("append").partitionBy("rule_version").parquet(path)


def found_blobs(spark: SparkSession, path: str, version: str = RULE_VERSION) -> DataFrame:
    """blob and spans of the blobs with findings, each once."""
    entries = read_ledger(spark, path).filter((F.col("rule_version") == version) & (F.size("spans") > 0))
    return entries.groupBy("blob").agg(F.first("spans").alias("spans"))


def findings(docs: DataFrame, path: str | None = None, version: str = RULE_VERSION, rules=RULES) -> DataFrame:
    """doc_id and spans of every row of docs, from the ledger at path (a new one, if null) and a scan of what it lacks.

    The new entries are written before they are joined back: a scan is not repeated for a lost task, and the
    join stands between two exchanges, so that the rows of one much-copied text can be split over tasks.
    Blobs without findings, nearly all, need no join.

    docs needs doc_id and text; other columns are not read. Defined results: a null or empty text has no
    spans; a null doc_id and repeated rows are returned as they are; an empty table gives none; spans of
    different kinds may overlap and all stay; a text of any length is one blob and scanned whole.
    """
    path = path or new_ledger(docs.sparkSession)
    scan(docs, path, version, rules)
    paths = address(docs).select("doc_id", "blob")
    return paths.join(found_blobs(docs.sparkSession, path, version), "blob", "left").select("doc_id", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))


def span_text(spans: Column, rules=RULES) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*(F.lit(r[0]) for r in rules))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """doc_id, counts by base kind, base_sha256 and spans (text) from findings()."""
    n = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"] < len(BASE_RULES))
    return found.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans")
    )


def redacted(docs: DataFrame, path: str | None = None, mark: str = "[SECRET]", version: str = RULE_VERSION, rules=RULES) -> DataFrame:
    """docs with every span of its texts replaced by mark (overlapping spans by one), all columns and rows kept.

    The spans come from the ledger at path (a new one, if null), by the address of the text, so ids may be null or
    repeat. n_chars, where docs has it, follows the new text. A null text stays null. Other columns may have any names.
    """
    path = path or new_ledger(docs.sparkSession)
    scan(docs, path, version, rules)
    text = F.coalesce(F.col("text"), F.lit(""))
    taken = {c.lower() for c in docs.columns}
    blob, spans = (next(x for x in (name + "_" * n for n in range(len(taken) + 1)) if x not in taken) for name in ("blob", "spans"))
    known = found_blobs(docs.sparkSession, path, version).select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    rows = docs.withColumn(blob, address_of(F.col("text"))).join(known, blob, "left")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        before = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        apart = F.struct(x["end"].alias("at"), F.concat(acc["out"], before, F.lit(mark)).alias("out"))
        longer = F.struct(F.greatest(x["end"], acc["at"]).alias("at"), acc["out"].alias("out"))
        return F.when((x["start"] < acc["at"]) & (acc["at"] > 0), longer).otherwise(apart)

    rest = lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))
    clean = F.when(F.col("text").isNotNull() & F.col(spans).isNotNull(), F.aggregate(spans, zero, step, rest)).otherwise(F.col("text"))
    out = rows.withColumn("text", clean).select(*(F.col(f"`{c}`") for c in docs.columns))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
