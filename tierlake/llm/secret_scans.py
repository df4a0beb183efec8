"""Secret scans over an incremental ledger of content-addressed blobs, in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its text. Only blobs that the ledger does not have
under the current rule version are scanned, once however many paths and versions hold them; the findings go to
the ledger, a Parquet table in the shared folder, and are joined back to all paths. A regular expression's
matches and the gaps between them give the code point offsets; both come from Java's matcher, so they agree.

Defined cases: a null text counts as empty and has no findings; repeated rows each get the findings of their
blob; an empty table gives an empty result; other columns are ignored by scan() and kept by redact(); the texts
of one blob are equal, so ties do not occur.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import stored, work_folder


@dataclass(frozen=True)
class Rule:
    """A kind of secret. least: code points that the group (0: the match) needs. hint: found in every match that counts."""

    kind: str
    pattern: str
    group: int
    least: int
    hint: str


ASSIGN = (
    r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
#: In the order that breaks ties between spans with one start.
RULES = (
    Rule("assign", ASSIGN, 2, 12, ASSIGN[:-2] + "{12})"),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18, "AKIA[A-Z0-9]{14}"),
    Rule("hex", "[0-9a-f]+", 0, 16, "[0-9a-f]{16}"),
)
VERSION = "1"
LEDGER = "blob binary, rule_version string, spans array<struct<start:int,place:int,kind:string,end:int,value:int>>"


def spans(text: Column, rule: Rule, place: int) -> Column:
    """The rule's matches in a text: start, end, and start of the secret value, in code points."""
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    value = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    parts = F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("hit"), value.alias("value"))
    none = F.array().cast("array<struct<start:int,place:int,kind:string,end:int,value:int>>")

    def add(seen: Column, part: Column) -> Column:
        start = seen["at"] + part["gap"]
        end = start + part["hit"]
        found = F.struct(
            start.alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"),
            end.alias("end"), (end - part["value"]).alias("value"),
        )
        return F.struct(
            end.alias("at"),
            F.when(part["value"] >= rule.least, F.concat(seen["found"], F.array(found))).otherwise(seen["found"]).alias("found"),
        )

    folded = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("found")), add, lambda x: x["found"])
    return F.when(F.regexp(text, F.lit(rule.hint)), folded).otherwise(none)


def scan_blobs(docs: DataFrame, ledger: DataFrame | None = None, version: str = VERSION) -> DataFrame:
    """Ledger rows (blob, rule_version, spans) of the texts that the ledger does not have under this rule version."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    blobs = texts.select(F.unhex(F.sha2("text", 256)).alias("blob"), "text")
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == version).select("blob")
        blobs = blobs.join(seen, "blob", "left_anti")
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    found = F.array_sort(F.concat(*(spans(F.col("text"), rule, i) for i, rule in enumerate(RULES))))
    return blobs.select("blob", F.lit(version).alias("rule_version"), found.alias("spans"))


def extend_ledger(docs: DataFrame, path: str, version: str = VERSION) -> DataFrame:
    """Scans what is unseen, appends it to the ledger at the path, and returns the whole ledger of this version.

    A path that does not exist yet is begun.
    """
    spark = docs.sparkSession
    try:
        ledger = spark.read.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        ledger = None
    scan_blobs(docs, ledger, version).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path).where(F.col("rule_version") == version)


def _with_findings(docs: DataFrame, ledger: DataFrame, columns: list[Column]) -> DataFrame:
    """The columns of each document and, as _spans, the findings of its text."""
    blob = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    found = ledger.where("size(spans) > 0").select(F.col("blob").alias("_found"), F.col("spans").alias("_spans"))
    rows = docs.select(*columns, blob.alias("_blob"))
    return rows.join(found, F.col("_blob") == F.col("_found"), "left").drop("_found")


def scan(docs: DataFrame, path: str | None = None, version: str = VERSION) -> DataFrame:
    """One row per document: doc_id, blob, matches by kind, and spans as kind:start:end by start and kind."""
    ledger = extend_ledger(docs, path or work_folder(docs.sparkSession, "ledger"), version)
    rows = _with_findings(docs, ledger, [F.col("doc_id")])
    found = F.coalesce("_spans", F.array().cast(ledger.schema["spans"].dataType))
    listed = F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(rule: Rule) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == rule.kind)).cast("bigint").alias(f"n_{rule.kind}")

    return rows.select(
        "doc_id", *map(count, RULES), F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"),
        F.lower(F.hex("_blob")).alias("blob"),
    )


def redact(docs: DataFrame, path: str | None = None, version: str = VERSION, mark: str = "[SECRET]") -> DataFrame:
    """The rows with all their columns; each secret value in a text is replaced by a mark, overlapping ones by one.

    n_chars, where the rows have it, is the new length.
    """
    ledger = extend_ledger(docs, path or work_folder(docs.sparkSession, "ledger"), version)
    rows = _with_findings(docs, ledger, [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")])
    text = F.col("row.text")

    def cut(seen: Column, s: Column) -> Column:
        start = F.greatest(s["value"], seen["at"])
        piece = F.concat(seen["text"], F.substring(text, seen["at"] + 1, F.greatest(start - seen["at"], F.lit(0))))
        fresh = s["value"] >= seen["at"]
        return F.struct(
            F.greatest(seen["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(piece, F.lit(mark))).otherwise(seen["text"]).alias("text"),
        )

    ordered = F.array_sort(F.transform("_spans", lambda s: F.struct(s["value"].alias("value"), s["end"].alias("end"))))
    clean = F.aggregate(
        ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("text")), cut,
        lambda x: F.concat(x["text"], F.substring(text, x["at"] + 1, F.length(text))),
    )
    row = F.col("row").withField("text", F.col("_clean"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("_clean").cast(docs.schema["n_chars"].dataType))
    new = F.when(F.col("_spans").isNotNull(), row).otherwise(F.col("row"))
    return rows.withColumn("_clean", clean).select(new.alias("row")).select("row.*")
