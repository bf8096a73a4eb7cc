"""Document fingerprints: invertible Bloom lookup tables of paragraph digests, in DataFrame functions only.

A text falls into paragraphs: sentences, cut at line ends and after at most twelve words. Its set of 64-bit
paragraph digests is thrown into cells that hold a count, the XOR of the digests and the XOR of their checks, each
digest into one cell of each of three rows. The cells of two versions subtract to the cells of what differs.
Peeling takes a cell that one digest is left in, notes the digest, takes it out of its other cells, and so on.
A table that gets stuck is built anew `GROWTH` times larger: its digests are dealt out to so many tables by further
bits. What is stuck after `RETRIES` such steps (odds below one in a billion) is compared digest by digest.

Nothing is shared between documents: a long text has many small tables and no large one, so the work is
in proportion to its length (times the logarithm, for dealing out).

A null text is as an empty one. Repeated paragraphs and their order don't count. Two texts without paragraphs
are alike (1.0). Equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardenlake.llm import ranges

PARAGRAPH = r"(?:[^\s.!?]++[^\S\n]*+){1,12}+[.!?]*+|[.!?]++"
ROWS, PER_ROW = 3, 4
CELLS = ROWS * PER_ROW
PAGE_ITEMS = 10  # digests of both versions that one table starts with at most; unrelated texts differ in all of them
GROWTH_BITS, RETRIES = 2, 4
FIRST_BIT = 8  # the bits before choose cells
CHECK_MASK = 0xFFFFFFFF
KEYS, NUMBERS = "array<bigint>", "array<int>"


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(found, lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(CHECK_MASK))


def _slot(key: Column, row: int) -> Column:
    return F.shiftright(key, 2 * row).bitwiseAND(F.lit(PER_ROW - 1).cast("long"))


def _let(value: Column, body) -> Column:
    """`body(value)` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sketch(keys: Column) -> Column:
    """CELLS cells (n, key, check) of a set of digests."""

    def cell(row: int, place: int) -> Column:
        mine = F.filter(keys, lambda k: _slot(k, row) == place)
        empty = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("check"))
        return F.aggregate(
            mine,
            empty,
            lambda c, k: F.struct(
                (c["n"] + 1).alias("n"), c["key"].bitwiseXOR(k).alias("key"), c["check"].bitwiseXOR(_check(k)).alias("check")
            ),
        )

    return F.array(*[cell(r, p) for r in range(ROWS) for p in range(PER_ROW)])


def subtract(left: Column, right: Column) -> Column:
    """The cells of what two sketches differ in: counts are positive for digests of the left one."""
    return F.zip_with(
        left,
        right,
        lambda a, b: F.struct(
            (a["n"] - b["n"]).alias("n"),
            a["key"].bitwiseXOR(b["key"]).alias("key"),
            a["check"].bitwiseXOR(b["check"]).alias("check"),
        ),
    )


def peel(cells: Column, most: Column) -> Column:
    """(cells, left, right, idle): digests recovered in at most `most` rounds, and what couldn't be peeled.

    A round takes all digests that are alone in some cell out of all their cells.
    """
    none = F.array().cast(KEYS)
    state = F.struct(cells.alias("cells"), none.alias("left"), none.alias("right"), F.lit(False).alias("idle"))

    def take(cells: Column, pure: Column) -> Column:
        """The cells without one digest; `places` has a bit for each of its cells."""
        key, one = pure["key"], F.lit(1)
        bits = [F.call_function("shiftleft", one, (_slot(key, row) + row * PER_ROW).cast("int")) for row in range(ROWS)]
        places = bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])

        def without(c: Column, i: Column, places: Column) -> Column:
            rest = F.struct(
                (c["n"] - pure["n"]).alias("n"),
                c["key"].bitwiseXOR(key).alias("key"),
                c["check"].bitwiseXOR(pure["check"]).alias("check"),
            )
            return F.when(F.call_function("shiftright", places, i).bitwiseAND(one) == 1, rest).otherwise(c)

        return _let(places, lambda p: F.transform(cells, lambda c, i: without(c, i, p)))

    def rest(s: Column) -> Column:
        return F.struct(s["cells"].alias("cells"), s["left"].alias("left"), s["right"].alias("right"), F.lit(True).alias("idle"))

    def take_all(s: Column, pure: Column) -> Column:
        def keys(sign: int) -> Column:
            return F.transform(F.filter(pure, lambda c: c["n"] == sign), lambda c: c["key"])

        return F.struct(
            F.aggregate(pure, s["cells"], take).alias("cells"),
            F.concat(s["left"], keys(1)).alias("left"),
            F.concat(s["right"], keys(-1)).alias("right"),
            F.lit(False).alias("idle"),
        )

    def step(s: Column, _: Column) -> Column:
        pure = F.filter(s["cells"], lambda c: (F.abs(c["n"]) == 1) & (_check(c["key"]) == c["check"]))
        taken = _let(F.array_distinct(pure), lambda found: F.when(F.size(found) > 0, take_all(s, found)).otherwise(rest(s)))
        return F.when(s["idle"], s).otherwise(taken)

    steps = F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast(NUMBERS))
    return F.aggregate(steps, state, step)


def _pair(left: Column, right: Column) -> Column:
    return F.struct(left.alias("left"), right.alias("right"))


def _halves(pages: Column, bit: Column) -> Column:
    """Every pair of digest sets as two, by one bit of the digests."""

    def side(keys: Column, value: int) -> Column:
        return F.filter(keys, lambda k: F.call_function("shiftright", k, bit).bitwiseAND(F.lit(1).cast("long")) == value)

    return F.flatten(
        F.transform(
            pages, lambda p: F.array(_pair(side(p["left"], 0), side(p["right"], 0)), _pair(side(p["left"], 1), side(p["right"], 1)))
        )
    )


def difference(pair: Column) -> Column:
    """(left, right): the digests that only one of two digest sets has, recovered by peeling."""
    none = F.array().cast(KEYS)
    items = F.size(pair["left"]) + F.size(pair["right"])
    enough = F.ceil(F.log2(F.greatest(F.lit(1.0), items / PAGE_ITEMS))).cast("int")

    def attempt(page: Column) -> Column:
        most = F.least(F.lit(2 * CELLS), F.size(page["left"]) + F.size(page["right"]))
        peeled = peel(subtract(sketch(page["left"]), sketch(page["right"])), most)
        return _let(
            peeled,
            lambda p: F.struct(
                F.forall(p["cells"], lambda c: (c["n"] == 0) & (c["key"] == 0)).alias("done"),
                p["left"].alias("left"),
                p["right"].alias("right"),
                page.alias("page"),
            ),
        )

    def larger(tried: Column, bit: Column) -> Column:
        pages = F.transform(F.filter(tried, lambda t: ~t["done"]), lambda t: t["page"])
        for more in range(GROWTH_BITS):
            pages = _halves(pages, bit + more)
        return pages

    def keep(tried: Column, side: str) -> Column:
        return F.flatten(F.transform(F.filter(tried, lambda t: t["done"]), lambda t: t[side]))

    def retry(s: Column, bit: Column) -> Column:
        after = _let(
            F.transform(s["todo"], attempt),
            lambda tried: F.struct(
                larger(tried, bit).alias("todo"),
                F.concat(s["left"], keep(tried, "left")).alias("left"),
                F.concat(s["right"], keep(tried, "right")).alias("right"),
            ),
        )
        return F.when(F.size(s["todo"]) == 0, s).otherwise(after)

    def finish(s: Column) -> Column:
        left = F.flatten(F.transform(s["todo"], lambda p: F.array_except(p["left"], p["right"])))
        right = F.flatten(F.transform(s["todo"], lambda p: F.array_except(p["right"], p["left"])))
        return F.struct(F.concat(s["left"], left).alias("left"), F.concat(s["right"], right).alias("right"))

    def run(bits: Column) -> Column:
        dealing = F.when(bits > 0, F.sequence(F.lit(0), bits - 1)).otherwise(F.array().cast(NUMBERS))
        pages = F.aggregate(dealing, F.array(_pair(pair["left"], pair["right"])), lambda ps, b: _halves(ps, b + FIRST_BIT))
        first = bits + FIRST_BIT
        tries = F.sequence(first, first + GROWTH_BITS * (RETRIES - 1), F.lit(GROWTH_BITS))
        return F.aggregate(tries, F.struct(pages.alias("todo"), none.alias("left"), none.alias("right")), retry, finish)

    return _let(enough, run)


def differences(sets: Column, others: list[Column]) -> Column:
    """The difference of a digest set to each of the others."""
    return F.transform(F.array(*[_pair(sets, other) for other in others]), difference)


def likeness(left: Column, right: Column, apart_sets: Column) -> Column:
    """Shared paragraphs over all paragraphs, from the sizes of two sets and their recovered difference."""
    apart = F.size(apart_sets["left"]) + F.size(apart_sets["right"])
    shared = (F.size(left) + F.size(right) - apart) / 2
    return F.when(shared + apart > 0, shared / (shared + apart)).otherwise(F.lit(1.0))


def fingerprint(keys: Column) -> Column:
    """The smallest table of a digest set as text: its size, then `count.digest.check` of every cell."""
    cells = F.transform(
        sketch(keys), lambda c: F.concat_ws(".", c["n"].cast("string"), F.lower(F.hex(c["key"])), F.lower(F.hex(c["check"])))
    )
    return F.concat_ws(":", F.size(keys).cast("string"), F.array_join(cells, ","))


def with_next(docs: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Adds `name`: `value` of the row with the next key; the last row gets that of the first. Null keys come last.

    One exchange, by ranges of the key. The first row of a range also goes to the end of the range before it.
    """
    splits = ranges.key_splits(docs, key, ranges.wanted_ranges(docs, "text"))
    n = ranges.count_ranges(splits)
    placed = ranges.with_range(docs, key, splits, "__range", nulls_last=True)
    firsts = placed.groupBy("__range").agg(F.min(key).alias("__first"))  # at most ranges.MOST_RANGES rows
    at_first = (F.col("__range") == F.col("__at")) & F.col(key).eqNullSafe(F.col("__first"))
    marked = placed.join(F.broadcast(firsts.withColumnRenamed("__range", "__at")), at_first, "left")
    own = F.struct(F.col("__range").alias("range"), F.lit(0).alias("copy"))
    before = F.struct(F.pmod(F.col("__range") - 1, F.lit(n)).cast("int").alias("range"), F.lit(1).alias("copy"))
    dealt = marked.withColumn("__place", F.explode(F.when(F.col("__at").isNull(), F.array(own)).otherwise(F.array(own, before))))
    flat = dealt.select(*docs.columns, F.col("__place.range").alias("__range"), F.col("__place.copy").alias("__copy"))
    order = Window.partitionBy("__range").orderBy("__copy", F.col(key).asc_nulls_last(), "text")
    ahead = flat.repartitionById(n, "__range").withColumn(name, F.lead(value).over(order))
    return ahead.where("__copy = 0").drop("__range", "__copy")


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Every document against its edited text (its second half from the next document) and the next document."""
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("own", digests(F.col("text")))
    pairs = with_next(own.withColumn("version", F.struct("text", "own")), "doc_id", "version", "next").drop("version")
    length = F.length("text")
    half = F.floor(length / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), length - half), F.substring(F.col("next.text"), F.lit(1), half))
    texts = pairs.select("doc_id", length.cast("long").alias("n_chars"), edited.alias("edited"), "own", F.col("next.own").alias("next"))
    sets = texts.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", digests(F.col("edited")).alias("edited"), "next"
    )
    both = sets.withColumn("apart", differences(F.col("own"), [F.col("edited"), F.col("next")]))
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited"), F.col("apart")[0]).alias("near_edited"),
        likeness(F.col("own"), F.col("next"), F.col("apart")[1]).alias("near_next"),
    )
