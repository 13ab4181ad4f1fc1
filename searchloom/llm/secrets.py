"""Secret scan: fixed patterns, and a battery of randomness tests for other tokens.

All of it is DataFrame functions.  Matches are places in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from searchloom.llm.tables import id_text, numbered
from searchloom.session import stage

#: Kinds in order, with the pattern and the least length of the group that counts.
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE = (("assign", ASSIGN, 2, 12), ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16))

#: Leaves the scan only matches that can pass; access and hex runs are taken whole anyway.
SCAN = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}

#: Runs of 16 or more that begin where no such run goes on.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}"
#: Signs at which a run is cut further: those foreign to base64, to its form for addresses, and to both.
CUTS = ("[_-]", "[+/]", "[+/_-]")
LEAST_TOKEN = 16
RANDOM = "random"
KINDS = [k for k, *_ in BASE] + [RANDOM]

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"

#: Encodings, tried in order: the characters and the alphabet in the order of its values.
ENCODINGS = (
    ("digits", r"^[0-9]+=*$", _DIGITS),
    ("hex", r"^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("HEX", r"^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("capitals", r"^[A-Z]+=*$", _UPPER),
    ("small", r"^[a-z]+=*$", _LOWER),
    ("letters", r"^[A-Za-z]+=*$", _UPPER + _LOWER),
    ("base32", r"^[A-Z2-7]+=*$", _UPPER + "234567"),
    ("base36", r"^[0-9a-z]+$", _DIGITS + _LOWER),
    ("base62", r"^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER),
    ("base64", r"^[A-Za-z0-9+/]+=*$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", r"^[A-Za-z0-9_-]+=*$", _UPPER + _LOWER + _DIGITS + "-_"),
)

#: Share of each letter in running English text, in per mille, a to z (fixed values).
LETTERS = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)

#: Text model: small letters, capitals, digits and signs hold these shares.
SHARES = (0.90, 0.04, 0.04, 0.02)

CONSISTENT = 0.01  # least combined p-value of a token that may be random
FALSE_SHARE = 0.05  # share of false discoveries in a class of lengths
BIN, TOP = 0.25, 400.0  # evidence is binned in steps of a quarter nat up to 400


def _listed(text: Column, kind: str, pattern: str, group: int | None = None) -> list[Column]:
    """Matches of a pattern, the group that counts, and the lengths of what lies between."""
    hit = F.rlike(text, F.lit(pattern))
    none = F.array().cast("array<string>")
    whole = F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    gaps = F.when(hit, F.transform(F.split(text, pattern, -1), F.length)).otherwise(
        F.array().cast("array<int>")
    )
    named = [whole.alias(f"{kind}_all"), gaps.alias(f"{kind}_gaps")]
    if group:
        part = F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(none)
        named.append(part.alias(f"{kind}_part"))
    return named


def _placed(found: DataFrame) -> DataFrame:
    """One row per match: its place follows from the lengths before it."""
    each = []
    for order, kind in enumerate(KINDS):
        part = f"{kind}_part" if f"{kind}_part" in found.columns else f"{kind}_all"
        zipped = F.arrays_zip(
            F.col(f"{kind}_all").alias("whole"), F.col(part).alias("part"), F.col(f"{kind}_gaps").alias("gap")
        )
        rows = found.where(F.size(f"{kind}_all") > 0).select(
            "row_no", F.lit(order).alias("kind_no"), F.posexplode(zipped).alias("pos", "m")
        )
        each.append(
            rows.where(F.col("m.whole").isNotNull()).select(
                "row_no", "kind_no", "pos", "m.whole", "m.part", "m.gap"
            )
        )
    rows = each[0]
    for more in each[1:]:
        rows = rows.unionByName(more)
    upto = Window.partitionBy("row_no", "kind_no").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("whole")).over(upto)
    return rows.select("row_no", "kind_no", "whole", "part", end.alias("end")).withColumn(
        "start", F.col("end") - F.length("whole")
    )


def _with_pieces(runs: DataFrame) -> DataFrame:
    """Every run and its pieces between signs that may belong to no key, each as a token of its own.

    A prefix or a path before a key, such as ``sk-``, has signs that the key's encoding lacks.
    """
    none = F.array().cast("array<struct<start:bigint,token:string>>")

    def step(state: Column, piece: Column) -> Column:
        one = F.struct(state["at"].alias("start"), piece.alias("token"))
        after = (state["at"] + F.length(piece) + 1).cast("bigint")
        return F.struct(after.alias("at"), F.array_append(state["done"], one).alias("done"))

    def cut(sign: str) -> Column:
        begin = F.struct(F.col("start").cast("bigint").alias("at"), none.alias("done"))
        pieces = F.aggregate(F.split("whole", sign, -1), begin, step, lambda state: state["done"])
        return F.when(F.rlike("whole", F.lit(sign)), pieces).otherwise(none)

    itself = F.array(F.struct(F.col("start").cast("bigint").alias("start"), F.col("whole").alias("token")))
    tokens = F.array_distinct(F.concat(itself, *[cut(sign) for sign in CUTS]))
    long_enough = F.filter(tokens, lambda t: F.length(t["token"]) >= LEAST_TOKEN)
    each = runs.select("row_no", "kind_no", F.col("start").alias("run"), F.explode(long_enough).alias("t"))
    token = F.col("t.token")
    return each.select(
        "row_no",
        "kind_no",
        "run",
        token.alias("whole"),
        token.alias("part"),
        (F.col("t.start") + F.length(token)).alias("end"),
        F.col("t.start").alias("start"),
    )


def _outermost(found: DataFrame) -> DataFrame:
    """Of the tokens found in one run those that lie in no other."""
    earlier = Window.partitionBy("row_no", "run").orderBy("start", F.desc("end"))
    reached = F.max("end").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    return found.withColumn("reached", reached).where(F.col("end") > F.coalesce("reached", F.lit(-1))).drop("reached")


def _tail(z: Column) -> Column:
    """Share of a normal distribution above ``z``, by the logistic approximation."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.least(F.lit(1.5976) * z + F.lit(0.07056) * z * z * z, F.lit(700.0))))


def _encoded(rows: DataFrame) -> DataFrame:
    """Infer the encoding."""
    body = F.rtrim(F.col("part"), F.lit("="))
    name = F.when(F.lit(False), F.lit(""))
    letters = F.lit(None).cast("string")
    for encoding, pattern, alphabet in reversed(ENCODINGS):
        fits = F.rlike(F.col("part"), F.lit(pattern))
        name = F.when(fits, encoding).otherwise(name)
        letters = F.when(fits, alphabet).otherwise(letters)
    return (
        rows.withColumn("encoding", name)
        .where(F.col("encoding").isNotNull())
        .withColumn("alphabet", letters)
        .withColumn("chars", F.split(body, ""))
    )


def battery(rows: DataFrame) -> DataFrame:
    """Add ``p_uniform``, ``p_runs``, ``p_serial``, their combination ``p_random`` and ``evidence``.

    ``part`` holds the token.  Chi-squared tests that all signs of the alphabet come
    equally often, the runs test that values change between the lower and the upper
    half as often as by chance, and the serial test that neighbours are unrelated.
    ``evidence`` is the logarithm of how much likelier the token is as uniformly drawn
    signs than as text: an e-value, which grows with the length of a random token.
    """
    rows = _encoded(rows)
    size, n = F.length("alphabet").cast("double"), F.size("chars").cast("double")
    values = F.transform("chars", lambda c: (F.instr(F.col("alphabet"), c) - 1).cast("double"))
    rows = rows.withColumn("values", values).withColumn("n", n).withColumn("size", size)
    # written out, or every test would spell the values anew
    rows = stage(rows.where(F.col("n") >= 8), "secret-candidates")
    values, n, size = F.col("values"), F.col("n"), F.col("size")

    def total(array: Column) -> Column:
        return F.aggregate(array, F.lit(0.0), lambda s, x: s + x)

    def meet(s: Column, x: Column) -> Column:
        run = F.when(s["last"] == x, s["run"] + 2).otherwise(F.lit(1.0))
        return F.struct(x.alias("last"), run.alias("run"), (s["sum"] + run).alias("sum"))

    # squares of the counts: the i-th of equal values adds 2i - 1
    begin = F.struct(F.lit(-1.0).alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))
    counts = F.aggregate(F.array_sort("values"), begin, meet, lambda s: s["sum"])
    rows = rows.withColumn("chi", size / n * counts - n)
    df = size - 1
    cube = F.lit(2.0) / (F.lit(9.0) * df)
    z_chi = (F.pow(F.greatest(F.col("chi"), F.lit(0.0)) / df, F.lit(1 / 3)) - (F.lit(1.0) - cube)) / F.sqrt(cube)

    left = F.slice(values, F.lit(1), (n - 1).cast("int"))
    right = F.slice(values, F.lit(2), (n - 1).cast("int"))
    rows = rows.withColumn("pairs", F.arrays_zip(left.alias("a"), right.alias("b")))
    half = size / 2
    upper = F.size(F.filter("values", lambda x: x >= half)).cast("double")
    changes = F.size(F.filter("pairs", lambda p: (p["a"] >= half) != (p["b"] >= half))).cast("double")
    rows = rows.withColumn("upper", upper).withColumn("runs", changes + 1)
    mean_runs = F.lit(2.0) * F.col("upper") * (n - F.col("upper")) / n + 1
    var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    z_runs = F.when(var_runs > 0, F.abs(F.col("runs") - mean_runs) / F.sqrt(var_runs)).otherwise(F.lit(8.0))

    rows = rows.withColumn("mean", total(values) / n)
    mean = F.col("mean")
    spread = total(F.transform("values", lambda x: (x - mean) * (x - mean)))
    product = total(F.transform("pairs", lambda p: (p["a"] - mean) * (p["b"] - mean)))
    r = F.when(spread > 0, product / spread).otherwise(F.lit(1.0))
    z_serial = F.abs(r + 1 / n) * F.sqrt(n)

    small, capital, digit, sign = SHARES
    per_letter = F.array(*[F.lit(small * x / sum(LETTERS)) for x in LETTERS])

    def log_text(c: Column) -> Column:
        at = F.instr(F.lit(_LOWER), c)
        return F.log(
            F.when(at > 0, F.element_at(per_letter, F.greatest(at, F.lit(1))))
            .when(F.instr(F.lit(_UPPER), c) > 0, F.lit(capital / 26))
            .when(F.instr(F.lit(_DIGITS), c) > 0, F.lit(digit / 10))
            .otherwise(F.lit(sign / 4))
        )

    evidence = -n * F.log(size) - total(F.transform("chars", log_text))
    least = F.lit(1e-300)
    rows = (
        rows.withColumn("p_uniform", F.greatest(_tail(z_chi), least))
        .withColumn("p_runs", F.greatest(F.least(2 * _tail(z_runs), F.lit(1.0)), least))
        .withColumn("p_serial", F.greatest(F.least(2 * _tail(z_serial), F.lit(1.0)), least))
        .withColumn("evidence", evidence)
    )
    x = -(F.log("p_uniform") + F.log("p_runs") + F.log("p_serial"))  # half of Fisher's sum
    return rows.withColumn("p_random", F.exp(-x) * (1 + x + x * x / 2)).drop(
        "values", "chars", "pairs", "mean", "upper", "runs", "chi", "alphabet", "size"
    )


def discoveries(
    tested: DataFrame, consistent: float = CONSISTENT, false_share: float = FALSE_SHARE
) -> DataFrame:
    """Tokens that may be random and whose evidence holds against all tokens of their length.

    Lengths are classed by powers of two.  Within a class of K tokens the k with the
    most evidence are kept for the largest k whose weakest has an e-value of at least
    K / (false_share * k), the step-up rule for e-values; evidence is compared on bins,
    so what meets is a table of at most 32 classes by ``TOP / BIN`` bins.
    """
    bin_no = F.floor(F.least(F.greatest("evidence", F.lit(0.0)), F.lit(TOP)) / BIN).cast("int")
    tested = tested.withColumn("length_class", F.floor(F.log2("n")).cast("int")).withColumn("bin_no", bin_no)
    counts = tested.groupBy("length_class", "bin_no").agg(F.count(F.lit(1)).alias("tokens"))
    whole = Window.partitionBy("length_class")
    from_top = whole.orderBy(F.desc("bin_no")).rowsBetween(Window.unboundedPreceding, 0)
    k = F.sum("tokens").over(from_top)
    needed = F.log(F.sum("tokens").over(whole)) - F.log(F.lit(false_share) * k)
    holds = counts.withColumn("holds", F.col("bin_no") * BIN >= needed)
    least = (
        holds.where("holds").groupBy("length_class").agg(F.min("bin_no").alias("least_bin"))
    )  # at most 32 rows
    kept = tested.join(F.broadcast(least), "length_class")
    return kept.where((F.col("bin_no") >= F.col("least_bin")) & (F.col("p_random") >= consistent))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row_no, doc_id, base, spans``: one row per row of ``docs``.

    ``base`` and ``spans`` are lists of ``(start, kind_no, end, value)`` by start, then
    kind; ``kind_no`` counts ``KINDS``.  ``spans`` adds the tokens the battery finds.
    Texts are read once; matches are written out and the rest works on those.  Null and
    empty texts have no spans; equal rows and ids are treated each by itself; other
    columns are not read; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    columns = []
    for kind, _, group, _ in BASE:
        columns += _listed(text, kind, SCAN[kind], group)
    columns += _listed(text, RANDOM, CANDIDATE)
    found = numbered(id_text(docs, id_col, text_col).select("doc_id", *columns), "secret-matches")
    placed = stage(_placed(found), "secret-places")
    least = F.lit(0)
    for order, (_, _, _, length) in enumerate(BASE):
        least = F.when(F.col("kind_no") == order, length).otherwise(least)
    base = placed.where((F.col("kind_no") < len(BASE)) & (F.length("part") >= least))
    tested = battery(_with_pieces(placed.where(F.col("kind_no") == len(BASE))))
    drawn = _outermost(discoveries(stage(tested, "secret-tests")))
    columns = ["row_no", "start", "kind_no", "end", "whole"]
    spans = base.select(*columns).unionByName(drawn.select(*columns))
    one = F.struct("start", "kind_no", "end", F.col("whole").alias("value"))
    grouped = spans.groupBy("row_no").agg(F.sort_array(F.collect_list(one)).alias("spans"))
    nothing = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint,value:string>>")
    joined = found.select("row_no", "doc_id").join(grouped, "row_no", "left")
    joined = joined.withColumn("spans", F.coalesce("spans", nothing))
    return joined.select(
        "row_no",
        "doc_id",
        F.filter("spans", lambda s: s["kind_no"] < len(BASE)).alias("base"),
        "spans",
    )


def span_text(spans: Column | str) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(kinds, s["kind_no"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
