"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by its content. A blob is scanned by a
version of the rules once: the ledger keeps what was found in it, be it nothing, and
later scans read only blobs that the ledger does not have for these rules. Findings
are then joined back to all paths with that content.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.sinks.places import path_exists


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, and how long the group that counts must be."""

    kind: str
    pattern: str
    group: int
    least: int


#: Fixed by the contract of op2: kinds in their order. A run of characters that is only
#: told apart by its length is matched with that length.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Names the rules in the ledger; new rules need a new one.
BASE_VERSION = "base-1"

#: Matches whose places are worked out together.
RUN = 512

_SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _matches(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule's matches by code point, leftmost and without overlap.

    The texts between matches and the matches alternate, so lengths give the places: first
    within runs of RUN matches, then the runs are moved to theirs. No array grows by more
    than a run at a time, however many matches a text has.
    """
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    between = F.split(text, rule.pattern, -1)
    rows = F.transform(
        F.arrays_zip(whole.alias("m"), F.slice(between, 1, F.size(whole)).alias("b"), counted.alias("g")),
        lambda row: F.struct(F.length(row["b"]).alias("b"), F.length(row["m"]).alias("m"), (F.length(row["g"]) >= rule.least).alias("kept")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(state: Column, row: Column) -> Column:
        begin = state["at"] + row["b"]
        end = begin + row["m"]
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(row["kept"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    def moved(spans: Column, by: Column) -> Column:
        return F.transform(spans, lambda s: F.struct((s["start"] + by).alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"), (s["end"] + by).alias("end")))

    def placed(rows: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / RUN).cast("int")), lambda k: F.aggregate(F.slice(rows, k * RUN + 1, RUN), start, step))
        first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("parts"))
        return F.aggregate(
            runs, first, lambda done, run: F.struct((done["at"] + run["at"]).alias("at"), F.concat(done["parts"], F.array(moved(run["spans"], done["at"]))).alias("parts")),
            lambda done: F.flatten(done["parts"]))

    # bound to a name, so that it is worked out once
    found = F.element_at(F.transform(F.array(rows), placed), 1)
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(_SPANS))


def spans(text: Column, rules: tuple[Rule, ...] = BASE_RULES) -> Column:
    """All matches in a text as ``(start, rank, kind, end)``, by start, then in the order of the rules."""
    return F.array_sort(F.concat(*[_matches(text, rule, k) for k, rule in enumerate(rules)]))


def joined(found: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(versions: DataFrame, ledger: str, path_column: str = "doc_id", text_column: str = "text",
         rules: tuple[Rule, ...] = BASE_RULES, rules_version: str = BASE_VERSION) -> DataFrame:
    """``(path, blob, spans)`` of every version, a row each; blobs new to the ledger are scanned and added to it.

    A null text is an empty one. Equal texts are one blob, however many paths and
    versions have it. Rows are kept as they are, repeated ones and null paths too; other
    columns are ignored. ``ledger`` is a folder that executors share; one writer at a time.
    """
    spark = versions.sparkSession
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    source = versions.select(F.col(path_column).alias("path"), text.alias("text"), F.sha2(text, 256).alias("blob"))
    blobs = source.groupBy("blob").agg(F.min(F.struct(F.coalesce(F.col("path").cast("string"), F.lit("")).alias("p"))).alias("s")).select(
        "blob", F.col("s.p").alias("p"))
    home = f"{ledger}/rules={rules_version}"
    if path_exists(spark, home):
        blobs = blobs.join(spark.read.parquet(home).select("blob"), "blob", "left_anti")
    # One row of each new blob goes to the scan: of its smallest path, where equal rows are
    # one for each task before they are shuffled.
    chosen = blobs.withColumnsRenamed({"blob": "b"})
    rows = source.withColumn("q", F.coalesce(F.col("path").cast("string"), F.lit(""))).groupBy("blob", "q").agg(F.first("text").alias("text"))
    new = rows.join(chosen, (F.col("blob") == F.col("b")) & (F.col("q") == F.col("p")), "left_semi")
    new.select("blob", spans(F.col("text"), rules).alias("spans")).write.mode("append").parquet(home)
    return source.select("path", "blob").join(spark.read.parquet(home), "blob", "left").select("path", "blob", "spans")
