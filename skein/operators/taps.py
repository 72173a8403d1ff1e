"""Several reports from one pass over a stream.

Every row gives one entry for each thing that a report counts: its group, its
fields, the values of these, its words, itself. The entries of all reports are one
array, one explode and one grouped aggregate with a map-side combine, keyed by report
and key; so the source is read once however many reports there are, and what is
written is a line for each distinct key (for the pair listing, a reply), never the
rows. Each report is a filter of
that table and, where it needs an order, a small sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from skein.functions.predicates import on_comment
from skein.functions.text import DELETED
from skein.operators import stats
from skein.operators.indexing import dense_index
from skein.operators.pairs import parent_key
from skein.session import staged

GROUP, FIELD, VALUE, WORD, PAIR, ROW = "group", "field", "value", "word", "pair", "row"
_STEP = 1 << 31         # an array index is below it


class Tally:
    """Entries of the wanted reports, collected before the pass."""

    def __init__(self, df: DataFrame):
        self.pos = df.schema["pos"].dataType
        self.whole = isinstance(self.pos, IntegralType)
        self.entries: list[Column] = []

    def _at(self, i: Column) -> Column:
        """Where an entry stands: its row, and its place in it."""
        if self.whole:
            return F.col("pos").cast("decimal(38,0)") * F.lit(_STEP) + i
        return F.struct(F.col("pos").alias("pos"), i.cast("int").alias("i"))

    def _entry(self, report: str, *keys: Column, i: Column | None = None, deleted: Column | None = None,
               pair: Column | None = None) -> Column:
        zero = F.lit(0)
        keys = [*keys, *[F.lit(None)] * (3 - len(keys))]
        return F.struct(F.lit(report).alias("report"), *[k.cast("string").alias(f"k{n}") for n, k in enumerate(keys)],
                        self._at(zero if i is None else i).alias("at"),
                        (zero if deleted is None else deleted.cast("int")).alias("deleted"),
                        (zero if pair is None else pair.cast("int")).alias("pair"))

    def groups(self) -> None:
        """For the summary."""
        self.entries.append(F.array(self._entry(
            GROUP, F.col("subreddit_id"), F.col("subreddit"),
            deleted=F.coalesce(F.col("body") == F.lit(DELETED), F.lit(False)),
            pair=F.coalesce(parent_key("parent_id").startswith("c"), F.lit(False)))))

    def fields(self, record: Column, values: bool, wanted=None) -> None:
        """For the field statistics (E5-E7) of a VARIANT; ``wanted`` tells the fields
        that count."""
        found = F.map_entries(record.cast("map<string,variant>"))
        if wanted is not None:
            found = F.filter(found, lambda e: wanted(e["key"]))
        one = (lambda e: self._entry(VALUE, e["key"], F.schema_of_variant(e["value"]), stats.value_text(e["value"]))) \
            if values else (lambda e: self._entry(FIELD, e["key"]))
        self.entries.append(F.transform(found, one))

    def words(self, tokens: Column, kept: Column) -> None:
        """For the vocabulary (V1) of the rows where ``kept`` holds."""
        listed = F.when(kept, F.transform(tokens, lambda w, i: self._entry(WORD, w, i=i)))
        self.entries.append(listed)

    def pairs(self, parent: Column, kept: Column) -> None:
        """For the pair listing (J3) of the replies where ``kept`` holds: a key each."""
        entry = self._entry(PAIR, F.col("id"), parent, F.col("pos"))
        self.entries.append(F.when(kept & on_comment("parent_id"), F.array(entry)))

    def rows(self, kept: Column) -> None:
        """For the number of rows where ``kept`` holds."""
        self.entries.append(F.when(kept, F.array(self._entry(ROW))))

    def count(self, df: DataFrame) -> DataFrame:
        """The pass: report, k0, k1, k2, n, at, deleted, pair; one line a key."""
        entries = F.flatten(F.filter(F.array(*self.entries), lambda a: a.isNotNull()))
        flat = df.select(F.explode_outer(entries).alias("e")).where("e IS NOT NULL").select("e.*")
        counted = flat.groupBy("report", "k0", "k1", "k2").agg(
            F.count(F.lit(1)).alias("n"), F.min("at").alias("at"), F.sum("deleted").alias("deleted"),
            F.sum("pair").alias("pair"))
        return staged(counted, "tallies")

    def first_pos(self) -> Column:
        at = F.floor(F.col("at") / F.lit(_STEP)) if self.whole else F.col("at.pos")
        return at.cast(self.pos)


def summary_totals(tallies: DataFrame) -> DataFrame:
    """comments, deleted, posts, pairs, subreddits (E1); a missing subreddit_id is a
    group of its own."""
    groups = tallies.where(F.col("report") == GROUP)
    n = F.coalesce(F.sum("n"), F.lit(0))
    pairs = F.coalesce(F.sum("pair"), F.lit(0))
    return groups.agg(n.alias("comments"), F.coalesce(F.sum("deleted"), F.lit(0)).alias("deleted"),
                      (n - pairs).alias("posts"), pairs.alias("pairs"),
                      (F.count_distinct("k0") + F.max(F.col("k0").isNull().cast("int"))).alias("subreddits"))


def summary_groups(tallies: DataFrame, tally: Tally) -> DataFrame:
    """Comments per subreddit id with its first name, in report order."""
    groups = tallies.where(F.col("report") == GROUP).withColumn("pos", tally.first_pos())
    return (groups.groupBy(F.col("k0").alias("subreddit_id"))
            .agg(F.sum("n").alias("n"), F.min_by("k1", "at").alias("subreddit"), F.min("pos").alias("first_pos"))
            .orderBy("n", "first_pos"))


def fields(tallies: DataFrame, tally: Tally, counts: bool) -> DataFrame:
    """Fields, or records per field in report order (E5, E6), from either statistic."""
    found = tallies.where(F.col("report").isin(FIELD, VALUE)).withColumn("pos", tally.first_pos())
    by_field = found.groupBy(F.col("k0").alias("field")).agg(F.sum("n").alias("n"), F.min("pos").alias("first_pos"))
    return by_field.orderBy("n", "first_pos") if counts else by_field.select("field")


def field_values(tallies: DataFrame) -> DataFrame:
    """Occurrences of each value of each field."""
    return tallies.where(F.col("report") == VALUE).select(
        F.col("k0").alias("field"), F.col("k1").alias("value_type"), F.col("k2").alias("value"), "n")


def vocabulary(tallies: DataFrame) -> DataFrame:
    """word, index, count (V1)."""
    words = tallies.where(F.col("report") == WORD).select(F.col("k0").alias("word"), F.col("n").alias("count"), "at")
    return dense_index(words, "at", "index").select("word", "index", "count")


def listed_pairs(tallies: DataFrame, tally: Tally) -> DataFrame:
    """(pos, id, parent_id) of every reply (J3); rows that are the same count each."""
    rows = tallies.where(F.col("report") == PAIR).withColumn("pos", tally.first_pos())
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))
    return rows.select("pos", F.col("k0").alias("id"), F.col("k1").alias("parent_id"), again.alias("_n")).drop("_n")


def row_count(tallies: DataFrame) -> DataFrame:
    return tallies.where(F.col("report") == ROW).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
