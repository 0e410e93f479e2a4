"""Line dedup: a suffix array over line ids by distributed prefix doubling; repeated line runs lose their later copies.

A document is a sequence of the ids of its lines that are not blank; every
place in it starts a suffix. Suffixes are ranked by their first line, then, in
rounds, by twice as many lines: the rank of 2 * w lines comes from sorting the
pairs (rank of w lines here, rank of w lines w further on). Equal ranks after w
lines are one interval of the suffix array with a common prefix of w lines or
more; a suffix alone in its interval leaves, so a round handles only what still
repeats, and the rounds end when nothing does. In each interval of enough lines
all but the first occurrence are later copies; the runs they cover, joined
where they meet, are the maximal repeated runs that are deleted.

DataFrame functions only. Pairs are aggregated before they are sorted and
ranked, so an interval is one row a partition on its way there, however often
its lines stand; ranks go back by a join, those of very wide intervals by a
broadcast of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

#: Fixed value: what a blank line may hold.
BLANK = " \t\r\x0b\x0c"
#: Occurrences of an interval from which its rank is sent to every task; more where MOST_WIDE of them could not bound what is sent.
WIDE = 1_000_000
MOST_WIDE = 10_000
DOC = ("doc_id", "tie")


def _length(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(BLANK)))


def _written(line: Column) -> Column:
    return _length(line) > 0


class LineDedup:
    """Runs of lines that stand earlier, in order of doc_id and line, are deleted.

    A run counts from `least_lines` lines on, or, where `least_chars` is given,
    as one line of so many characters (blanks around it apart). Null text
    counts as empty; blank lines belong to no run and stay. A null doc_id comes
    before all others. Rows of one doc_id are ordered by the hashes of their
    texts; rows equal in both keep each other's lines. Only doc_id and text
    decide; other columns pass through apply().
    """

    def __init__(self, docs: DataFrame, least_lines: int = 2, least_chars: int | None = None):
        self.docs, self.least, self.chars = docs, least_lines, least_chars
        text = F.coalesce(F.col("text"), F.lit(""))
        self.keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"), F.struct("*").alias("row"))

    def _lines(self) -> DataFrame:
        """(doc_id, tie, at, long, a, b): a row for each line that isn't blank, its place among these, its id of two 64-bit hashes."""
        named = F.transform(
            F.split("text", "\n"),
            lambda x: F.when(_written(x), F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit("second"), x).alias("b"), (_length(x) >= (self.chars or 0)).alias("long"))),
        )
        # the outer form: the plain one makes the planner filter on size(names) first, which computes all names again, several times over
        lines = self.keyed.select(*DOC, F.posexplode_outer(F.filter(named, lambda x: x.isNotNull())).alias("at", "line")).filter("line is not null")
        return lines.select(*DOC, "at", "line.*")

    def _ranked(self, suffixes: DataFrame) -> DataFrame | None:
        """Of suffixes (doc_id, tie, at, long, a, b) those whose (a, b) is not theirs alone, with their rank in order of (a, b) and the first place of their interval."""
        place = F.struct(*DOC, "at")
        intervals = suffixes.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
        # sorted by range, so that the running number of a row keeps their order
        intervals = checkpointed(intervals.orderBy("a", "b").withColumn("rank", F.monotonically_increasing_id()))
        found = intervals.agg(F.sum("n")).first()[0]
        if not found:
            return None
        wide = max(WIDE, found // MOST_WIDE)
        if found > wide:
            known = suffixes.join(F.broadcast(intervals.filter(F.col("n") > wide).select("a", "b", "rank", "first")), ["a", "b"], "left")
            ranked = known.filter("rank is not null").unionByName(known.filter("rank is null").drop("rank", "first").join(intervals.filter(F.col("n") <= wide).drop("n"), ["a", "b"]))
        else:
            ranked = suffixes.join(intervals.drop("n"), ["a", "b"])
        return checkpointed(ranked.select(*DOC, "at", "long", "rank", "first"))

    def intervals(self) -> Iterator[tuple[int, DataFrame]]:
        """(width, suffixes): the suffixes that share their first `width` lines with another one, as (doc_id, tie, at, long, rank, first).

        Widths double, by way of `least_lines`; suffixes of one rank are one
        interval of the suffix array, which is in order of (rank, doc_id, tie, at).
        """
        width, ranked = 1, self._ranked(self._lines())
        while ranked is not None:
            yield width, ranked
            step = min(width, self.least - width) if width < self.least else width
            further = Window.partitionBy(*DOC).orderBy("at").rangeBetween(step, step)
            pairs = ranked.select(*DOC, "at", "long", F.col("rank").alias("a"), F.max("rank").over(further).alias("b")).filter("b is not null")
            width, ranked = width + step, self._ranked(pairs)

    def _copies(self) -> DataFrame:
        """(doc_id, tie, at, width): later copies of runs that count, the widest at each place."""
        spark, out = self.docs.sparkSession, None
        for width, suffixes in self.intervals():
            later = suffixes.filter(F.struct(*DOC, "at") > F.col("first"))
            if width < self.least:
                if width > 1 or self.chars is None:
                    continue
                later = later.filter("long")
            found = later.select(*DOC, "at", F.lit(width).alias("width"))
            out = found if out is None else out.unionByName(found)
        return out if out is not None else spark.createDataFrame([], "doc_id long, tie long, at int, width int")

    def _runs(self) -> DataFrame:
        """(doc_id, tie, start, n_lines): the maximal runs that are deleted."""
        before = Window.partitionBy(*DOC).orderBy("at", "width").rowsBetween(Window.unboundedPreceding, -1)
        marked = self._copies().withColumn("new", (F.col("at") > F.coalesce(F.max(F.col("at") + F.col("width")).over(before), F.lit(-1))).cast("int"))
        run = F.sum("new").over(Window.partitionBy(*DOC).orderBy("at", "width").rowsBetween(Window.unboundedPreceding, 0))
        runs = marked.withColumn("run", run).groupBy(*DOC, "run").agg(F.min("at").alias("start"), F.max(F.col("at") + F.col("width")).alias("end"))
        return runs.select(*DOC, "start", (F.col("end") - F.col("start")).alias("n_lines"))

    def runs(self) -> DataFrame:
        """(doc_id, start, n_lines): the maximal runs that are deleted, by place among the lines not blank."""
        return self._runs().drop("tie")

    def _cleaned(self) -> DataFrame:
        """Each document's row, with its text without later copies."""
        found = self._runs().groupBy(F.col("doc_id").alias("found_id"), F.col("tie").alias("found_tie")).agg(F.array_sort(F.collect_list(F.struct("start", "n_lines"))).alias("runs"))
        joined = self.keyed.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("tie") == F.col("found_tie")), "left")
        # each column once: within a lambda an expression would be computed for each element
        lines = joined.withColumn("lines", F.split("text", "\n"))
        placed = lines.withColumn("places", F.filter(F.transform("lines", lambda x, i: F.when(_written(x), i)), lambda i: i.isNotNull()))
        spans = placed.withColumn("gone", F.transform("runs", lambda r: F.struct(F.element_at("places", r["start"] + 1).alias("begin"), (F.element_at("places", r["start"] + r["n_lines"]) + 1).alias("end"))))
        part = lambda a, z: F.slice("lines", a + 1, F.greatest(z - a, F.lit(0)))
        kept = F.flatten(F.transform("gone", lambda g, i: F.concat(part(F.when(i > 0, F.col("gone")[F.greatest(i - 1, F.lit(0))]["end"]).otherwise(0), g["begin"]), F.filter(part(g["begin"], g["end"]), lambda x: ~_written(x)))))
        kept = F.concat(kept, part(F.element_at("gone", -1)["end"], F.size("lines")))
        return spans.select(
            "row",
            "doc_id",
            F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
            F.size("places").cast("long").alias("n_lines"),
            F.coalesce(F.aggregate("runs", F.lit(0), lambda s, r: s + r["n_lines"]), F.lit(0)).cast("long").alias("n_removed"),
            F.greatest(F.coalesce(F.size("runs"), F.lit(0)), F.lit(0)).cast("long").alias("n_runs"),
        )

    def texts(self) -> DataFrame:
        """doc_id, text without later copies, n_lines, n_removed, n_runs: a row for each document."""
        return self._cleaned().drop("row")

    def apply(self) -> DataFrame:
        """The documents with their own columns and their texts without later copies; those of which no line is left go."""
        left = self._cleaned().filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
        new = {"text": F.when(F.col("n_removed") > 0, F.col("text")).otherwise(F.col("row.text")), "n_chars": F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars")) if "n_chars" in self.docs.columns else None}
        return left.select(*(new[c].cast(self.docs.schema[c].dataType).alias(c) if new.get(c) is not None else F.col("row").getField(c).alias(c) for c in self.docs.columns))


#: DuckDB, for the lines of documents: the same rule by windows of two lines and by single lines of `chars` characters.
ORACLE_SQL = r"""
WITH l AS (SELECT doc_id, i AS pos, lines[i] AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM {docs}), unnest(generate_series(1, len(lines))) AS g(i)),
t AS (SELECT doc_id, pos, line, length(trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12))) AS size FROM l),
s AS (SELECT doc_id, pos, line, size, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM t WHERE size > 0),
w AS (SELECT a.doc_id, a.k, a.line AS x, b.line AS y FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.k = a.k + 1),
f AS (SELECT x, y, min(struct_pack(d := doc_id, p := k)) AS lead FROM w GROUP BY x, y),
later AS (SELECT w.doc_id, w.k FROM w JOIN f ON w.x = f.x AND w.y = f.y WHERE struct_pack(d := w.doc_id, p := w.k) > f.lead),
g AS (SELECT line, min(struct_pack(d := doc_id, p := k)) AS lead FROM s WHERE size >= {chars} GROUP BY line),
single AS (SELECT s.doc_id, s.k FROM s JOIN g ON s.line = g.line WHERE struct_pack(d := s.doc_id, p := s.k) > g.lead),
gone AS (SELECT doc_id, k FROM later UNION SELECT doc_id, k + 1 FROM later UNION SELECT doc_id, k FROM single),
heads AS (SELECT doc_id, k, k IS DISTINCT FROM 1 + lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS head FROM gone),
marked AS (SELECT l.doc_id, l.pos, l.line, s.k IS NOT NULL AS written, h.k IS NOT NULL AS gone, coalesce(h.head, false) AS head FROM l LEFT JOIN s ON l.doc_id = s.doc_id AND l.pos = s.pos LEFT JOIN heads h ON s.doc_id = h.doc_id AND s.k = h.k)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text, count(*) FILTER (WHERE written) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE head) AS n_runs FROM marked GROUP BY doc_id
"""
