r"""Secret scans through an incremental ledger of blobs, with DataFrame functions only.

A blob is one content of one version of one path, named by its SHA-256; the ledger has a row for each
blob and rule version that was ever scanned, with the spans found. ``scan`` names every version's blob,
looks up in the ledger the blobs that it was given, and no others,
keeps one text of each blob with a rule version that the ledger hasn't seen, scans those only, and joins
the spans of ledger and scan back to all paths. A text that many paths share is moved once per map task
and scanned once, however many there are.

Spans are leftmost non-overlapping matches of a rule's pattern, those dropped whose group is too short;
ends are exclusive, counted in code points. They come from the lengths of the matches and of what
``split`` leaves between them, summed by a window within one blob and rule.

Defined results: null text is an empty one; empty text has no spans; repeated rows each get their spans;
an empty table gives empty results; other columns pass through, but for those with a result's name, which gives way to it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import Scratch, hidden, shown


@dataclass(frozen=True)
class Rule:
    """group: the part of a match whose length must reach ``least``; a higher version scans old blobs again."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1
    base: bool = True


#: The base rules in their order. Where only a whole match counts, the least length is in the pattern:
#: a maximal run that is long enough starts where the run does, so the matches are the same.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Forms that are secrets by themselves, wherever they stand.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", base=False),
)
RULES = BASE + MORE

_HIT = "struct<start:int,rank:int,end:int,kind:string>"
LEDGER = "blob string, rule string, version int, spans array<struct<start:int,rank:int,end:int,kind:string>>"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _parts(text: Column, rule: Rule) -> Column:
    """A struct for each match, in order: length of the gap before it, its own, its group's; empty where none is."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, rule.pattern, -1)
    made = F.transform(
        F.arrays_zip(found.alias("m"), part.alias("g"), F.slice(gaps, F.lit(1), F.size(found)).alias("p")),
        lambda x: F.struct(F.length(x["p"]).alias("gap"), F.length(x["m"]).alias("len"), F.length(x["g"]).alias("part")),
    )
    return F.when(F.rlike(text, F.lit(rule.pattern)), made).otherwise(F.array().cast("array<struct<gap:int,len:int,part:int>>"))


def find_spans(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Columns blob, text, wanted (array of rule names) -> ledger rows, one for each blob and wanted rule.

    blobs must have a blob once; its rows are not moved again.
    """
    each = F.array(
        *[
            F.when(F.array_contains("wanted", r.name), F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), F.lit(k).alias("rank"), F.lit(r.least).alias("least"), _parts(F.col("text"), r).alias("parts")))
            for k, r in enumerate(rules)
        ]
    )
    tall = blobs.select("blob", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("r")).select("blob", "r.*")
    rows = tall.select("blob", "rule", "version", "rank", "least", F.posexplode_outer("parts").alias("k", "m"))
    upto = Window.partitionBy("blob", "rule").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("m.gap") + F.col("m.len")).over(upto).cast("int"))
    hit = F.struct((F.col("end") - F.col("m.len")).alias("start"), F.col("rank"), F.col("end"), F.col("rule").alias("kind"))
    rows = rows.select("blob", "rule", "version", F.when(F.col("m.part") >= F.col("least"), hit).alias("hit"))
    return rows.groupBy("blob", "rule", "version").agg(F.sort_array(F.collect_list("hit")).alias("spans"))


class Ledger:
    """The ledger as a table under a folder that all executors see, partitioned by the first digit of the blob."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        return self.spark.read.schema(f"{LEDGER}, prefix string").parquet(self.path)

    def append(self, new: DataFrame) -> None:
        rows = new.withColumn("prefix", F.substring("blob", 1, 1))
        rows.hint("rebalance", "prefix").write.mode("append").partitionBy("prefix").parquet(self.path)


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, *, text: str = "text", carry: list[str] | None = None, keep: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings, new ledger rows): findings has the carried columns, ``blob`` and ``spans`` for every row of versions.

    spans: by start, then rule; structs (start, rank, end, kind). Append the new rows to the ledger to
    keep them; a row of the ledger for another version of a rule doesn't count as seen. With ``keep``, new
    rows are written there first.
    """
    cols, pairs = hidden(versions, carry if carry is not None else versions.columns)
    body = F.coalesce(versions[f"`{text}`"], F.lit(""))
    named = versions.select(*cols, blob_of(body).alias("__blob"))
    blobs = versions.select(blob_of(body).alias("blob"), body.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    names = F.array(*[F.lit(r.name) for r in rules]) if rules else F.array().cast("array<string>")
    if ledger is None:
        wanted = blobs.withColumn("wanted", names)
        old = None
    else:
        current = reduce(or_, [(F.col("rule") == r.name) & (F.col("version") == r.version) for r in rules], F.lit(False))
        mine = named.select(F.col("__blob").alias("blob"), F.substring("__blob", 1, 1).alias("prefix")).distinct()
        by = [c for c in ("prefix", "blob") if c in ledger.columns]
        # Of the ledger only rows of these blobs go on; its parts that have none of them aren't read.
        old = ledger.where(current).join(mine, by, "left_semi")
        old = old.select("blob", "rule", "version", "spans").dropDuplicates(["blob", "rule"])
        old = old if keep is None else keep.keep(old, "known")
        seen = old.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        wanted = blobs.join(seen, "blob", "left").withColumn("wanted", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))).drop("seen")
    new = find_spans(wanted.where(F.size("wanted") > 0), rules)
    new = new if keep is None else keep.keep(new, "ledger")
    known = new if old is None else new.unionByName(old)
    per = known.where(F.size("spans") > 0).groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    if keep is not None:  # the paths of one blob then meet its findings in a join that can be split
        per = keep.keep(per, "findings")
    found = named.join(per, named["__blob"] == per["blob"], "left")
    empty = F.array().cast(f"array<{_HIT}>")
    return found.select(*shown(pairs, "blob", "spans"), F.col("__blob").alias("blob"), F.coalesce("spans", empty).alias("spans")), new


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch that a span covers replaced; spans that touch or overlap make one stretch."""
    kind = "array<struct<start:int,end:int>>"
    merged = F.aggregate(
        spans,
        F.array().cast(kind),
        lambda a, s: F.when(
            (F.size(a) > 0) & (F.element_at(a, -1)["end"] >= s["start"]),
            F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end")))),
        )
        .otherwise(F.concat(a, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))
        .cast(kind),
    )
    kept = F.transform(merged, lambda s, k: F.substring(text, F.when(k == 0, F.lit(1)).otherwise(F.get(merged, k - 1)["end"] + 1), s["start"] - F.when(k == 0, F.lit(0)).otherwise(F.get(merged, k - 1)["end"])))
    tail = F.substring(text, F.element_at(merged, -1)["end"] + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(F.transform(kept, lambda x: F.concat(x, F.lit(mark))), ""), tail)).otherwise(text)
