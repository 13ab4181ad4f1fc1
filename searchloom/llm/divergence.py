"""Where sources of a language differ in their words: one-hot level products, priced exactly.

What a term adds to the divergence of two groups depends on its two counts (levels) alone.
So the terms of a block become a matrix of indicator columns, one for each (group, level)
met in it, and the product of the matrix with its transpose holds, for each two groups,
how many terms have which two levels: all joint tables at once.  A price per pair
of levels, times those numbers, is the block's share of every divergence.

Products are of 0 and 1 in single precision, over fewer than 2^24 rows, so they are exact; prices are
whole numbers and summed in two halves of 30 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from searchloom.llm.blocks import LOWER, blocks
from searchloom.llm.lexicon import Lexicon
from searchloom.llm.tables import text_batches
from searchloom.session import shuffle_partitions, stage

SCALE = 10**9
LEAST_DOCS, TOP_TERMS = 3, 200
TERMS = 4096  # of a language, about, in one task's table
GROUPS = 64  # of a language in one block of columns
COLUMNS = 1024  # of one product, unless a few terms have more
SALTS = 16
HALF = 30

_LETTERS = np.zeros(256, bool)
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = _LETTERS[0x80:] = True

GROUP = ["lang", "source"]
SLOT = ["lang", "slot", "i", "j"]


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` of ``(lang, source, text)``: occurrences, and documents that have it.

    Terms are runs of ASCII letters, lower-cased, and of characters beyond ASCII.  Rows are
    counted by megabytes of text before anything is shuffled.
    """

    def count(batches):
        for batch in batches:
            names = [batch.column(i).dictionary_encode() for i in (0, 1)]
            sources = max(1, len(names[1].dictionary))
            group_of = names[0].indices.to_numpy().astype(np.int64) * sources + names[1].indices.to_numpy()
            for block in blocks(batch.column(2)):
                words = Lexicon(block, _LETTERS, LOWER)
                if not len(words.codes):
                    continue
                row, distinct = words.rows(), len(words.distinct)
                key = group_of[block.first + row] * distinct + words.codes
                order = np.argsort(key, kind="stable")  # rows of one key stay in order
                key, row = key[order], row[order]
                begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                fresh = np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]))
                group, code = np.divmod(key[begin], distinct)
                yield pa.RecordBatch.from_arrays(
                    [
                        names[0].dictionary.take(pa.array(group // sources)),
                        names[1].dictionary.take(pa.array(group % sources)),
                        words.distinct.take(pa.array(code)).cast(pa.large_string()).cast(pa.string()),
                        pa.array(np.diff(np.append(begin, len(key)))),
                        pa.array(np.add.reduceat(fresh, begin, dtype=np.int64)),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )

    found = docs.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(count: str | Column, total: str, terms: str) -> Column:
    """``1 + floor(10^9 * (count + 1) / (total + terms))``, exact for any count."""
    count = F.col(count) if isinstance(count, str) else count
    wide = "decimal(28,0)"
    product = (F.lit(SCALE).cast("decimal(10,0)") * (count.cast(wide) + 1).cast(wide)).cast("decimal(38,0)")
    return 1 + F.call_function("div", product, (F.col(total).cast(wide) + F.col(terms)).cast("decimal(38,0)"))


def price(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``; both are at most ``10^9 + 1``, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _exact(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """As :func:`probability`, in whole numbers of any size."""
    return np.array([1 + SCALE * (c + 1) // (total + terms) for c in counts.tolist()], np.int64)


class _Levels:
    """The indicator columns of some terms' counts, group by group, and their probabilities."""

    def __init__(self, counts: np.ndarray, totals: list[int], terms: int):
        met = [np.unique(column, return_inverse=True) for column in counts.T]
        self.first = np.cumsum([0] + [len(levels) for levels, _ in met])[:-1]
        self.width = int(sum(len(levels) for levels, _ in met))
        self.places = np.stack([inverse.ravel() + at for (_, inverse), at in zip(met, self.first)], axis=1)
        self._met, self._totals, self._terms = met, totals, terms

    def one_hot(self) -> np.ndarray:
        x = np.zeros((len(self.places), self.width), np.float32)
        x[np.arange(len(x))[:, None], self.places] = 1.0
        return x

    def p(self) -> np.ndarray:
        return np.concatenate([_exact(levels, t, self._terms) for (levels, _), t in zip(self._met, self._totals)])


def _priced(joint: np.ndarray, p: np.ndarray, q: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Sums of number times price over each group's levels, as high and low halves."""
    difference = p[:, None] - q[None, :]
    prices = difference * difference // q[None, :]
    halves = [(prices >> HALF) * joint, (prices & ((1 << HALF) - 1)) * joint]
    return np.stack([np.add.reduceat(np.add.reduceat(x, rows, axis=0), columns, axis=1) for x in halves])


def _pair_sums(columns: int):
    """For each two groups of a slot, the summed prices of its terms; ``rest`` is the price of a term neither has."""
    names = ["lang", "source", "item", "high", "low", "met", "terms", "rest"]

    def run(table: pa.Table) -> pa.Table:
        lang, i, j = table["lang"][0].as_py(), table["i"][0].as_py(), table["j"][0].as_py()
        marks = table.filter(pc.is_null(table["term"])).sort_by("g")
        rows = table.filter(pc.is_valid(table["term"]))
        total, terms = marks["total"].to_pylist(), marks["terms"][0].as_py()
        sources, side = marks["source"].to_pylist(), marks["g"].to_numpy() // GROUPS
        coded = rows["term"].combine_chunks().dictionary_encode()
        counts = np.zeros((len(coded.dictionary), len(sources)), np.int64)
        column = np.searchsorted(marks["g"].to_numpy(), rows["g"].to_numpy())
        counts[coded.indices.to_numpy(), column] = rows["n"].to_numpy()
        # Terms of like frequency next to each other share their levels.
        counts = counts[np.argsort(counts.sum(axis=1), kind="stable")]
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        sums = np.zeros((2, len(sources), len(sources)), np.int64)
        at, step = 0, TERMS
        while at < len(counts):
            part = counts[at : at + step]
            a = _Levels(part[:, left], [total[x] for x in left], terms)
            b = a if i == j else _Levels(part[:, right], [total[x] for x in right], terms)
            if max(a.width, b.width) > columns and len(part) > 16:
                step = max(16, len(part) // 2)
                continue
            x = a.one_hot()
            joint = (x.T @ (x if b is a else b.one_hot())).astype(np.int64)
            p, q = a.p(), b.p()
            sums[:, left[:, None], right[None, :]] += _priced(joint, p, q, a.first, b.first)
            if b is not a:
                sums[:, right[:, None], left[None, :]] += _priced(joint.T, q, p, b.first, a.first)
            at, step = at + len(part), min(TERMS, 2 * step)
        wanted = side[:, None] != side[None, :] if i != j else ~np.eye(len(sources), dtype=bool)
        s, t = np.nonzero(wanted)
        zero = [1 + SCALE // (n + terms) if terms else 1 for n in total]
        rest = [(zero[x] - zero[y]) ** 2 // zero[y] for x, y in zip(s.tolist(), t.tolist())]
        known = pa.array(sources, pa.string())
        out = [
            pa.array([lang] * len(s), pa.string()),
            known.take(pa.array(s)),
            known.take(pa.array(t)),
            pa.array(sums[0][s, t]),
            pa.array(sums[1][s, t]),
            pa.array(np.full(len(s), len(counts))),
            pa.array(np.full(len(s), terms)),
            pa.array(rest, pa.int64()),
        ]
        return pa.Table.from_arrays(out, names=names)

    return run


def _pairs(rows: DataFrame, groups: DataFrame, columns: int) -> DataFrame:
    """``lang, source, item, value`` of each two sources of a language."""
    spark = rows.sparkSession
    several = groups.where(F.col("groups") > 1)
    sides = F.ceil(F.col("groups") / GROUPS).cast("int")
    slots = F.greatest(F.ceil(F.col("terms") / TERMS), F.lit(1)).cast("int")
    mine = F.floor(F.col("g") / GROUPS).cast("int")
    facts = ["source", "g", "total", "terms"]

    def paired(df: DataFrame) -> DataFrame:
        other = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
        return other.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))

    placed = several.withColumn("sides", sides).withColumn("slots", slots).withColumn("mine", mine)
    marks = placed.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    none = [F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("n")]
    counted = rows.where(F.col("groups") > 1).withColumn("sides", sides).withColumn("mine", mine)
    counted = counted.withColumn("slot", F.pmod(F.xxhash64("term"), slots).cast("int"))
    both = paired(marks).select(*SLOT, *facts, *none).unionByName(paired(counted).select(*SLOT, *facts, "term", "n"))
    tables = placed.groupBy("lang").agg(F.first("slots").alias("a"), F.first("sides").alias("b"))
    whole = tables.agg(F.sum(F.col("a") * F.col("b") * (F.col("b") + 1) / 2)).first()[0] or 1
    tasks = int(min(20_000, max(shuffle_partitions(spark), whole)))
    schema = "lang string, source string, item string, high bigint, low bigint, met bigint, terms bigint, rest bigint"
    parts = both.repartition(tasks, *SLOT).groupBy(*SLOT).applyInArrow(_pair_sums(columns), schema)
    wide = "decimal(38,0)"
    value = F.col("high") * F.lit(1 << HALF).cast("decimal(10,0)") + F.col("low")
    value = value + ((F.col("terms") - F.col("met")).cast("decimal(19,0)") * F.col("rest").cast("decimal(19,0)"))
    return (
        parts.groupBy(*GROUP, "item")
        .agg(
            F.sum(F.col("high").cast("decimal(20,0)")).cast("decimal(26,0)").alias("high"),
            F.sum(F.col("low").cast("decimal(20,0)")).cast("decimal(26,0)").alias("low"),
            F.sum("met").alias("met"),
            F.max("terms").alias("terms"),
            F.max("rest").alias("rest"),
        )
        .select(*GROUP, "item", value.cast(wide).cast("bigint").alias("value"))
    )


def source_divergence(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    top_terms: int = TOP_TERMS,
    columns: int = COLUMNS,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group of a language and a source.

    A language keeps the ``V`` terms that ``least_docs`` of its documents have.  Each group, and each
    language as a whole, gives a term it has ``count`` times ``p = 1 + floor(10^9 (count + 1) / (N + V))``,
    ``N`` being its occurrences of kept terms.  A term's divergence of ``p`` from ``q`` is
    ``floor((p - q)^2 / q)``.  In part ``pair`` an item is another source of the language, and the value sums
    over all kept terms; in part ``term`` an item is a kept term the group has and uses more than
    its language does, the ``top_terms`` first.  Ranks go by value, falling, then item.

    Null text, language or source counts as empty text.  A group without terms has counts of zero; without
    kept terms values are 0 and there are no terms; a language of one source has no pairs; repeated rows count as often as
    they come; an empty table gives no rows.  Other columns are not read.

    Counts are combined before each shuffle; a language's terms go to slots by hash, some
    ``TERMS`` each, so no language, source or term is one key, and of more than ``GROUPS`` sources two
    blocks meet at a time.  Terms are cut to ``top_terms`` per group inside the tasks first.
    """
    text = [F.coalesce(docs[c].cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)]
    plain = text_batches(docs).select(*[c.alias(n) for c, n in zip(text, ("lang", "source", "text"))])
    counts = stage(term_counts(plain), "term-counts")
    same_term = Window.partitionBy("lang", "term")
    kept = stage(
        counts.withColumn("held", F.sum("docs").over(same_term))
        .where(F.col("held") >= least_docs)
        .select(
            *GROUP,
            "term",
            "n",
            F.sum("n").over(same_term).alias("lang_n"),
            (F.row_number().over(same_term.orderBy("source")) == 1).alias("head"),
        ),
        "kept-terms",
    )
    of_group = kept.groupBy(*GROUP).agg(F.sum("n").alias("n"), F.count_if("head").alias("heads"))
    groups = plain.select(*GROUP).distinct().join(of_group, GROUP, "left").fillna(0, ["n", "heads"])
    of_lang = Window.partitionBy("lang")
    groups = stage(
        groups.select(
            *GROUP,
            F.col("n").alias("total"),
            F.sum("heads").over(of_lang).alias("terms"),
            F.sum("n").over(of_lang).alias("lang_total"),
            F.count(F.lit(1)).over(of_lang).alias("groups"),
            (F.row_number().over(of_lang.orderBy("source")) - 1).alias("g"),
        ),
        "groups",
    )
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = kept.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
    rows = stage(rows.join(salted, [*GROUP, "salt"]).drop("salt", "head"), "priced-terms")

    by_value = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    p, q = probability("n", "total", "terms"), probability("lang_n", "lang_total", "terms")
    terms = rows.select(*GROUP, F.col("term").alias("item"), p.alias("p"), q.alias("q")).where(F.col("p") > F.col("q"))
    terms = terms.select(*GROUP, "item", price(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms)
    pairs = _pairs(rows, groups, columns).withColumn("rank", F.row_number().over(by_value))
    shown = [*GROUP, "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair"))
        .select(*shown)
        .unionByName(terms.withColumn("part", F.lit("term")).select(*shown))
    )
