"""Tables as Parquet snapshots: upserts, ignored inserts, deletes and checkpoints over whole tables or some documents.

Parquet has no updates. A table lies in ``BUCKETS`` parts by document; a change writes the parts of the documents it
touches beside the old ones, and then a manifest that names every part's folder, so a failed write leaves the old
table in place and nothing is read and overwritten in one plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import CLAUSE_KINDS, REFERENCE_KINDS, STATUSES, TABLES
from .scratch import held

# ---- changes as plans


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: list[str], keep: str | None = None) -> DataFrame:
    """One row for each key: the last of the new by ``order``, else the old. ``keep`` names an id that the first row of a key gives."""
    rows = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    last = Window.partitionBy(*key).orderBy(F.desc("__new"), *[F.desc(c) for c in order])
    first = Window.partitionBy(*key).orderBy("__new", *order)
    if keep:
        rows = rows.withColumn(keep, F.first(keep, True).over(first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return rows.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n", "__new")


def insert_ignore(old: DataFrame, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """old, and of each key that it lacks the first new row by ``order``."""
    fresh = new.join(old.select(*key), key, "left_anti")
    first = Window.partitionBy(*key).orderBy(*order)
    kept = fresh.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")
    return old.unionByName(kept, allowMissingColumns=True)


def update(old: DataFrame, new: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """old with the columns' new values, where there are some."""
    given = new.select(*key, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = old.join(given, key, "left")
    return joined.select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in old.columns])


def delete(old: DataFrame, gone: DataFrame, key: list[str]) -> DataFrame:
    return old.join(gone.select(*key).distinct(), key, "left_anti")


def _document(clause_id: str):
    return F.shiftright(F.col(clause_id), 24)


def _numbered(rows: DataFrame, old: DataFrame, document, ident: str, fresh, own, order: str):
    """rows with ``__id``: that of fresh ones goes on from the highest that their document has, or is their own where it has none."""
    top = old.groupBy(document(ident).alias("__d")).agg(F.max(ident).alias("__top"))
    place = F.sum(F.when(fresh, 1).otherwise(0)).over(Window.partitionBy("__doc").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    joined = rows.join(top, F.col("__doc") == F.col("__d"), "left")
    return joined.withColumn("__id", F.when(F.col("__top").isNull(), own(place)).otherwise(F.col("__top") + place)).drop("__d", "__top")


def merged_clauses(old: DataFrame, new: DataFrame) -> DataFrame:
    """old clauses, and a parse's new ones over them, one for each (document, citation).

    A citation that is there keeps its id; others get ids that no clause of their document has. Parents, which the parse names by its
    own ids, are those of the same citation.
    """
    key = ["document_id", "citation"]
    named = new.join(old.select(*key, F.col("clause_id").alias("__kept")), key, "left").withColumn("__doc", F.col("document_id"))
    named = _numbered(named, old, _document, "clause_id", F.col("__kept").isNull(), lambda _: F.col("clause_id"), "clause_id")
    named = named.withColumn("__id", F.coalesce("__kept", "__id"))
    above = named.select(F.col("clause_id").alias("__own"), F.col("__id").alias("__above"))
    named = named.join(above, F.col("parent_id") == F.col("__own"), "left")
    new = named.withColumn("parent_id", F.col("__above")).withColumn("clause_id", F.col("__id")).drop("__kept", "__doc", "__id", "__own", "__above")
    return upsert(old, new, key, ["ord"], keep="clause_id")


def merged_references(old: DataFrame, new: DataFrame) -> DataFrame:
    """old references, and the new ones of a (source, raw text, target) that they lack, under ids that no reference of their document has."""
    key = ["src_clause_id", "raw_text", "target_citation"]
    first = Window.partitionBy(*key).orderBy("reference_id")
    fresh = new.join(old.select(*key), key, "left_anti").withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n").withColumn("__doc", _document("src_clause_id"))
    own = lambda place: F.shiftleft(F.col("__doc"), 24) + place
    fresh = _numbered(fresh, old, _document, "reference_id", F.lit(True), own, "reference_id")
    return old.unionByName(fresh.withColumn("reference_id", F.col("__id")).drop("__doc", "__id"), allowMissingColumns=True)


def pending(units: DataFrame, checkpoints: DataFrame, key: list[str]) -> DataFrame:
    """Units whose checkpoint isn't done; failed ones are pending."""
    return units.join(checkpoints.where("status = 'done'").select(*key), key, "left_anti")


def completed(checkpoints: DataFrame) -> DataFrame:
    """Distinct units that are done, without the marker of whole documents, 0."""
    return checkpoints.where("status = 'done' AND unit_id > 0").select(*[c for c in ("document_id", "unit_id") if c in checkpoints.columns]).distinct()


def checked(rows: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """rows, failing where a value isn't allowed."""
    bad = ~F.coalesce(F.col(column).isin(*allowed), F.lit(False))
    return rows.withColumn(column, F.when(bad, F.raise_error(F.concat(F.lit(f"{column} is "), F.coalesce(F.col(column), F.lit("null"))))).otherwise(F.col(column)))


_ALLOWED = {"clauses": ("kind", CLAUSE_KINDS), "clause_references": ("kind", REFERENCE_KINDS), "checkpoints": ("status", STATUSES)}


# ---- the store

BUCKETS = 64
#: What says which document a row belongs to.
_OF_DOCUMENT = {"clause_references": "shiftright(src_clause_id, 24)", "rule_cards": "shiftright(clause_id, 24)"}


def bucket_of(table: str):
    return F.pmod(F.xxhash64(F.expr(_OF_DOCUMENT.get(table, "document_id")).cast("long")), F.lit(BUCKETS)).cast("int")


class Store:
    """Named tables under a root folder that all executors see; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str, start: str) -> list[int]:
        where = self._path(folder)
        names = [s.getPath().getName() for s in self._fs.listStatus(where)] if self._fs.exists(where) else []
        return sorted(int(n[len(start) :]) for n in names if n.startswith(start) and n[len(start) :].isdigit())

    def _versions(self, table: str) -> list[int]:
        return self._names(f"{self.root}/{table}", "manifest-")

    def _manifest(self, table: str, version: int) -> dict[int, int]:
        """Bucket -> the version that wrote it last."""
        text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        stream = self._fs.open(self._path(f"{self.root}/{table}/manifest-{version}"))
        try:
            return {int(k): int(v) for k, v in (line.split() for line in text.toString(stream, "UTF-8").splitlines())}
        finally:
            stream.close()

    def _name(self, table: str, version: int, parts: dict[int, int]) -> None:
        """The manifest counts once it has its name."""
        path = f"{self.root}/{table}/manifest-{version}"
        stream = self._fs.create(self._path(f"{path}.new"), True)
        stream.write(bytearray("".join(f"{k} {v}\n" for k, v in sorted(parts.items())), "utf-8"))
        stream.close()
        if not self._fs.rename(self._path(f"{path}.new"), self._path(path)):
            raise RuntimeError(f"{path} can't be written")

    def read(self, table: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table, or some of its buckets, with the schema of today: columns that older files lack are null."""
        versions = self._versions(table)
        parts = self._manifest(table, versions[-1]) if versions else {}
        paths = [f"{self.root}/{table}/v{v}/bucket={k}" for k, v in sorted(parts.items()) if buckets is None or k in buckets]
        return self.spark.read.schema(TABLES[table]).parquet(*paths) if paths else self.spark.createDataFrame([], TABLES[table])

    def write(self, table: str, rows: DataFrame, buckets: Sequence[int] | None = None, keep: int = 2) -> DataFrame:
        """The next version: of the whole table, or of some buckets, which hold all of rows; what the last ``keep`` versions don't name goes."""
        if table in _ALLOWED:
            rows = checked(rows, *_ALLOWED[table])
        schema = TABLES[table]
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in rows.columns]
        rows = rows.select("*", *missing).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        versions = self._versions(table)
        version, where = max([0, *versions, *self._names(f"{self.root}/{table}", "v")]) + 1, f"{self.root}/{table}"
        rows.withColumn("bucket", bucket_of(table)).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{where}/v{version}")
        parts = {k: v for k, v in (self._manifest(table, versions[-1]) if versions and buckets is not None else {}).items() if k not in buckets}
        self._name(table, version, parts | dict.fromkeys(self._names(f"{where}/v{version}", "bucket="), version))
        kept = [*versions, version][-keep:]
        used = {v for k in kept for v in self._manifest(table, k).values()}
        for old in {*versions} - {*kept}:
            self._fs.delete(self._path(f"{where}/manifest-{old}"), False)
        for old in {*self._names(where, "v")} - used - {version}:
            self._fs.delete(self._path(f"{where}/v{old}"), True)
        return self.read(table)

    def patch(self, table: str, touching: DataFrame, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``change`` of the buckets of the documents of ``touching``; the others aren't read or written."""
        buckets = [r[0] for r in touching.select(bucket_of(table)).distinct().collect()]
        return self.write(table, change(self.read(table, buckets)), buckets) if buckets else self.read(table)

    def init(self) -> None:
        for table in TABLES:
            if not self._versions(table):
                self.write(table, self.spark.createDataFrame([], TABLES[table]))

    def register(self, rows: DataFrame) -> DataFrame:
        """rows (source_path, title): documents, one for each path; existing ones keep their id."""
        old = self.read("documents")
        top = old.agg(F.coalesce(F.max("document_id"), F.lit(0))).first()[0]
        fresh = rows.select("source_path", "title").join(old.select("source_path"), "source_path", "left_anti").groupBy("source_path").agg(F.min("title").alias("title"))
        spread = fresh.repartitionByRange("source_path").sortWithinPartitions("source_path").withColumn("at", F.monotonically_increasing_id())
        # Ids are dense: the place in a partition, after the partitions before it.
        with held(spread.withColumn("part", F.shiftright("at", 33)).withColumn("row", F.col("at").bitwiseAND((1 << 33) - 1))) as placed:
            sizes = sorted((r["part"], r["count"]) for r in placed.groupBy("part").count().collect())
            starts, n = [], top + 1
            for part, count in sizes:
                starts.append((part, n))
                n += count
            base = self.spark.createDataFrame(starts, "part long, base long")
            new = placed.join(F.broadcast(base), "part").select((F.col("base") + F.col("row")).alias("document_id"), "source_path", "title", F.current_timestamp().alias("ingested_at"))
            return self.patch("documents", new, lambda old: old.unionByName(new))

    def insert(self, rows: DataFrame) -> DataFrame:
        """As ``register``, but a path that is there, or twice in rows, is an error."""
        again = rows.groupBy("source_path").count().where("count > 1").select("source_path")
        there = rows.select("source_path").join(self.read("documents").select("source_path"), "source_path", "left_semi")
        found = again.union(there).first()
        if found:
            raise ValueError(f"a document has the path {found[0]!r} already")
        return self.register(rows)

    def mark(self, rows: DataFrame, stage: str) -> DataFrame:
        """rows (document_id, unit_id, status[, artifact_path]): checkpoints of a stage, the new ones over the old."""
        with held(rows.withColumn("stage", F.lit(stage)).withColumn("updated_at", F.current_timestamp())) as new:
            return self.patch("checkpoints", new, lambda old: upsert(old, new, ["document_id", "stage", "unit_id"], ["updated_at"]))

    def completed(self, stage: str) -> DataFrame:
        return completed(self.read("checkpoints").where(F.col("stage") == stage))

    def save_pages(self, rows: DataFrame) -> DataFrame:
        with held(rows) as new:
            return self.patch("ocr_pages", new, lambda old: upsert(old, new, ["document_id", "page_ordinal"], ["raw_text"]))

    def save_clauses(self, rows: DataFrame) -> DataFrame:
        with held(rows) as new:
            return self.patch("clauses", new, lambda old: merged_clauses(old, new))

    def save_references(self, rows: DataFrame) -> DataFrame:
        with held(rows) as new:
            return self.patch("clause_references", new, lambda old: merged_references(old, new))

    def save_cards(self, rows: DataFrame) -> DataFrame:
        with held(rows) as new:
            return self.patch("rule_cards", new, lambda old: upsert(old, new, ["card_id"], ["clause_id"]))

    def save_embeddings(self, rows: DataFrame) -> DataFrame:
        """rows (card_id, clause_id, embedding)."""
        with held(rows) as new:
            return self.patch("rule_cards", new, lambda old: update(old, new, ["card_id"], ["embedding"]))

    def delete_documents(self, gone: DataFrame) -> int:
        """Clauses of documents, with the references from them; the number of clauses that went."""
        with held(gone.select("document_id").distinct()) as gone, held(self.read("clauses").join(gone, "document_id", "left_semi").select(F.col("clause_id").alias("src_clause_id"))) as lost:
            self.patch("clause_references", lost, lambda old: delete(old, lost, ["src_clause_id"]))
            self.patch("clauses", gone, lambda old: delete(old, gone, ["document_id"]))
            return lost.count()

    def by(self, table: str, **values) -> DataFrame:
        """Rows whose columns have these values; with a document's id, of its bucket alone."""
        document = values.get("document_id")
        buckets = None
        if document is not None and table not in _OF_DOCUMENT:
            buckets = [r[0] for r in self.spark.range(1).select(F.lit(document).cast("long").alias("document_id")).select(bucket_of(table)).collect()]
        return self.read(table, buckets).where(reduce(lambda a, b: a & b, [F.col(c) == v for c, v in values.items()]))
