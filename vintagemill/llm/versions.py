"""Operator 11: document fingerprints as invertible Bloom lookup sketches, in native expressions only.

A text's paragraphs are its lines, long ones cut at the first end of a sentence after 300
characters.  Each distinct paragraph and its number of copies make a key.  A sketch
has three parts of equal width; a key lies in one cell of each part, where keys are
counted and XORed, and so are their check numbers.  Subtracting the sketches of two
versions leaves the cells of the keys that only one of them has.  A cell with
a single key shows it, and taking that key out of its other cells may bare more:
peeling, until all cells are empty and the differing keys are recovered.

Where peeling gets stuck the sketches were too small: larger ones are tried, each of twice
as many cells and with hashes of its own.  Only cells in use are kept, so a
larger sketch costs no more than a small one.

All of this is done inside a row, in time that grows with the paragraphs (times
their logarithm, for sorting).  Whole texts are shuffled twice: to fold equal rows,
and to ranges of their order, where every document finds the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import documents, written

# The pattern of a paragraph, and numbers below 2^60.
PARAGRAPH = r"[^\n]{1,300}[^\n.!?]*[.!?]*"
KEYS = 1 << 60
PER_COPY = 1_000_003
CHECK = 2_147_483_629
PARTS = 3
# Cells of a part of a fingerprint, and of a part of the larger sketches for each key.
WIDTH = 8
CELLS_A_KEY = (2, 4, 8, 16)
ROUNDS = 12
ITEM_BITS = 24
ITEMS = 1 << ITEM_BITS
COPIES = 100_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _runs(values: Column, new: Callable[[Column, Column], Column], body: Callable[[Column, Column], Column]) -> Column:
    """``body(first place, length)`` of each run of a sorted array; ``new`` tells two neighbours apart."""

    def starts(places: Column) -> Column:
        return F.filter(places, lambda i: (i == 0) | new(F.get(values, i), F.get(values, i - 1)))

    def of(begin: Column) -> Column:
        return F.transform(begin, lambda i, j: body(i, F.coalesce(F.get(begin, j + 1), F.size(values)) - i))

    return let(starts(F.transform(values, lambda _, i: i)), of)


def paragraph_keys(text: Column) -> Column:
    """Numbers below 2^60, one per distinct paragraph and its number of copies, in order of their digests.

    Null has none, like the empty text.
    """
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))
    digest = F.transform(pieces, lambda p: F.conv(F.substring(F.md5(p), 1, 15), 16, 10).cast("long"))
    return let(
        F.sort_array(digest),
        lambda found: _runs(
            found, lambda a, b: a != b, lambda i, n: (F.get(found, i) + PER_COPY * (n - 1).cast("long")) % KEYS
        ),
    )


def _cell(cell: Column, count: Column, keys: Column, checks: Column) -> Column:
    return F.struct(cell.alias("cell"), count.alias("count"), keys.alias("keys"), checks.alias("checks"))


def _signed(keys: Column, second: bool = False) -> Column:
    """Keys with the version that they belong to in their last bit."""
    return F.transform(keys, lambda k: k * 2 + int(second))


def _entries(signed: Column, width: Column, salted: bool, taken: bool = False) -> Column:
    """What each key adds to a cell of each part; the second version's keys, or those taken out, count less.

    Fingerprints take the cells from the key's own bits, larger sketches from a
    hash that differs with their width.
    """

    def of(entry: Column) -> Column:
        key = F.shiftright(entry, 1)
        bits = F.shiftrightunsigned(F.xxhash64(key, width), 4) if salted else key
        sign = F.when(entry % 2 == (0 if taken else 1), -1).otherwise(1)
        return F.array(
            *[
                _cell(F.shiftright(bits, 20 * part) % (1 << 20) % width + width * part, sign, key, key % CHECK)
                for part in range(PARTS)
            ]
        )

    return F.flatten(F.transform(signed, of))


def _gathered(items: Column) -> Column:
    """The sums of equal cells, in order; cells that come to nothing are left out."""

    def sums(items: Column, order: Column) -> Column:
        def at(place: Column) -> Column:
            return F.get(items, (place % ITEMS).cast("int"))

        def added(place: Column, n: Column) -> Column:
            start = _cell(
                F.shiftright(F.get(order, place), ITEM_BITS), F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long")
            )
            return F.aggregate(F.slice(order, place + 1, n), start, lambda c, p: plus(c, at(p)))

        def plus(c: Column, more: Column) -> Column:
            return _cell(
                c["cell"],
                c["count"] + more["count"],
                c["keys"].bitwiseXOR(more["keys"]),
                c["checks"].bitwiseXOR(more["checks"]),
            )

        return _runs(
            order,
            lambda p, q: F.shiftright(p, ITEM_BITS) != F.shiftright(q, ITEM_BITS),
            lambda place, n: F.when(n == 1, at(F.get(order, place))).otherwise(added(place, n)),
        )

    def of(items: Column) -> Column:
        order = F.sort_array(F.transform(items, lambda c, i: F.shiftleft(c["cell"], ITEM_BITS) + i))
        return let(order, lambda o: sums(items, o))

    return F.filter(let(items, of), lambda c: (c["count"] != 0) | (c["keys"] != 0) | (c["checks"] != 0))


def sketch(keys: Column) -> Column:
    """The fingerprint of an array of keys: its cells in use (cell, count, keys, checks) in order."""
    return _gathered(_entries(_signed(keys), F.lit(WIDTH).cast("long"), salted=False))


def subtract(a: Column, b: Column) -> Column:
    """The cells of a sketch less those of another of the same width."""
    less = F.transform(b, lambda c: _cell(c["cell"], -c["count"], c["keys"], c["checks"]))
    return _gathered(F.concat(a, less))


def peel(cells: Column, width: Column, salted: bool) -> Column:
    """The cells that are left of two subtracted sketches, and the signed keys that were recovered."""

    def bare(state: Column) -> Column:
        alone = F.filter(state["cells"], lambda c: (F.abs(c["count"]) == 1) & (c["checks"] == c["keys"] % CHECK))
        return F.array_distinct(F.transform(alone, lambda c: c["keys"] * 2 + F.when(c["count"] < 0, 1).otherwise(0)))

    def advance(state: Column, found: Column) -> Column:
        left = _gathered(F.concat(state["cells"], _entries(found, width, salted, taken=True)))
        return F.struct(
            F.when(F.size(found) == 0, state["cells"]).otherwise(left).alias("cells"),
            F.concat(state["found"], found).alias("found"),
            (F.size(found) == 0).alias("still"),
        )

    start = F.struct(cells.alias("cells"), F.array().cast("array<bigint>").alias("found"), F.lit(False).alias("still"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        lambda state, _: F.when(state["still"], state).otherwise(
            let(bare(state), lambda found: advance(state, found))
        ),
    )


def _larger(a: Column, b: Column) -> Column:
    """The signed keys in which two versions differ, from sketches of more and more cells.

    Sketches subtract cell by cell, so both versions' keys go into one, with their signs.
    """
    signed = F.concat(_signed(a), _signed(b, second=True))

    def attempt(signed: Column, cells: Column) -> Column:
        width = F.size(signed).cast("long") * cells
        return peel(_gathered(_entries(signed, width, salted=True)), width, salted=True)

    def of(signed: Column) -> Column:
        unsolved = F.array(_cell(*[F.lit(0).cast(kind) for kind in ("long", "int", "long", "long")]))
        start = F.struct(
            unsolved.alias("cells"), F.array().cast("array<bigint>").alias("found"), F.lit(True).alias("still")
        )
        return F.aggregate(
            F.array(*map(F.lit, CELLS_A_KEY)),
            start,
            lambda state, cells: F.when(F.size(state["cells"]) == 0, state).otherwise(attempt(signed, cells)),
        )

    return let(signed, of)


def with_differences(rows: DataFrame, pairs: str, into: str) -> DataFrame:
    """Add the keys in which each pair (``a``, ``b``: keys; ``cells_a``, ``cells_b``: fingerprints) differs.

    Keys are signed, as in :func:`_signed`.  A pair is peeled from its fingerprints; where
    that gets stuck, from larger sketches, each twice the one before.  All of them get stuck with
    odds of about one in 10^15 a pair, which is then compared key by key.
    """
    own = F.transform(
        pairs,
        lambda p: F.struct(
            p["a"].alias("a"),
            p["b"].alias("b"),
            peel(subtract(p["cells_a"], p["cells_b"]), F.lit(WIDTH).cast("long"), salted=False).alias("peeled"),
        ),
    )
    rows = rows.withColumn("_own", own)
    larger = F.transform(
        "_own",
        lambda p: F.when(F.size(p["peeled"]["cells"]) == 0, p["peeled"]).otherwise(_larger(p["a"], p["b"])),
    )
    rows = rows.withColumn("_larger", larger)

    def settled(pair: Column, found: Column) -> Column:
        plain = F.concat(
            _signed(F.array_except(pair["a"], pair["b"])), _signed(F.array_except(pair["b"], pair["a"]), second=True)
        )
        return F.when(F.size(found["cells"]) == 0, found["found"]).otherwise(plain)

    return rows.withColumn(into, F.zip_with("_own", "_larger", settled)).drop("_own", "_larger")


def only_in(found: Column, second: bool) -> Column:
    """The keys of one version among signed ones."""
    return F.transform(F.filter(found, lambda e: e % 2 == int(second)), lambda e: F.shiftright(e, 1))


def likeness(keys: Column, found: Column) -> Column:
    """Share of common keys of all keys of two versions, from the first one's keys and the difference.

    Two versions without any are alike.
    """
    only_a, only_b = F.size(only_in(found, second=False)), F.size(only_in(found, second=True))
    every = F.size(keys) + only_b
    return F.when(every == 0, 1.0).otherwise((F.size(keys) - only_a) / every)


def fingerprint_text(cells: Column) -> Column:
    """The cells in use as text: number, count, keys and checks in hexadecimal."""
    shown = F.transform(
        cells,
        lambda c: F.concat_ws(":", c["cell"], c["count"], F.lower(F.hex(c["keys"])), F.lower(F.hex(c["checks"]))),
    )
    return F.array_join(shown, ",")


def compare_versions(rows: DataFrame, old: str, new: str, into: str = "changes") -> DataFrame:
    """Rows with a struct of fingerprints, likeness and the differing keys of two texts.

    Null texts count as empty; two empty texts have likeness 1, and one empty text 0 with any
    other.  Equal texts have equal fingerprints, and repeated rows equal results.  Texts are
    read whole, and very long ones take time in proportion.  All other columns are kept, one
    named like ``into`` is replaced; an empty table gives an empty one.
    """

    kept = [F.col(f"`{c}`") for c in rows.columns if c != into]
    keys = [paragraph_keys(F.col(f"`{c}`")).alias(name) for c, name in ((old, "a"), (new, "b"))]
    versions = rows.select(F.struct(*kept).alias("_rest"), *keys)
    versions = versions.select("*", sketch(F.col("a")).alias("cells_a"), sketch(F.col("b")).alias("cells_b"))
    pair = F.array(F.struct("a", "b", "cells_a", "cells_b"))
    found = with_differences(versions.withColumn("_pairs", pair), "_pairs", "_found")
    changes = F.struct(
        fingerprint_text(F.col("cells_a")).alias("old_fingerprint"),
        fingerprint_text(F.col("cells_b")).alias("new_fingerprint"),
        likeness(F.col("a"), F.col("_found")[0]).alias("likeness"),
        only_in(F.col("_found")[0], second=False).alias("only_old"),
        only_in(F.col("_found")[0], second=True).alias("only_new"),
    )
    return found.select("_rest", changes.alias("_changes")).select("_rest.*", F.col("_changes").alias(into))


def with_next_text(docs: DataFrame) -> DataFrame:
    """Distinct (doc_id, text) with ``copies`` and the text of the next one, after the last the first.

    The order is by id (without one first), then by digest of the text.  Rows go to
    ranges of it whose bounds come from the ids and digests alone; the first row of a range
    also stands at the end of the range before it, so every row finds its next one there.
    """
    spark = docs.sparkSession
    # More ranges than partitions, as they are dealt to these by hash.
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    place = F.struct("doc_id", "digest")
    narrow = given.select("doc_id", F.md5("text").alias("digest")).distinct()
    lowest = (
        narrow.repartitionByRange(ranges, "doc_id", "digest")
        .groupBy(F.spark_partition_id().alias("range"))
        .agg(F.min(place).alias("lowest"))
    )
    # One row per range, read back as one array.
    bounds = written(lowest, "bounds").agg(F.sort_array(F.collect_list("lowest")).alias("b")).scalar()
    rows = given.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("digest", F.md5("text")).withColumn("bounds", bounds)

    def search(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        fits = F.get("bounds", middle) <= place
        nearer = F.struct(
            F.when(fits, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(fits, state["high"]).otherwise(middle).alias("high"),
        )
        return F.when(state["low"] < state["high"], nearer).otherwise(state)

    whole = F.struct(F.lit(0).alias("low"), F.size("bounds").alias("high"))
    steps = F.sequence(F.lit(1), F.lit(ranges.bit_length() + 1))
    own = F.aggregate(steps, whole, search)["low"] - 1
    rows = rows.withColumn("range", own)
    first = F.get("bounds", F.col("range")) == place
    before = F.pmod(F.col("range") - 1, F.size("bounds"))
    here = F.struct(F.col("range"), F.lit(False).alias("guest"))
    guest = F.struct(before.alias("range"), F.lit(True).alias("guest"))
    stands = F.explode(F.when(first, F.array(here, guest)).otherwise(F.array(here)))
    dealt = rows.select("doc_id", "digest", "text", "copies", stands.alias("at")).select("*", "at.*").drop("at")
    order = Window.partitionBy("range").orderBy("guest", "doc_id", "digest")
    return (
        dealt.withColumn("next_text", F.lead("text").over(order))
        .where("not guest")
        .select("doc_id", "text", "copies", "next_text")
    )


def op11_lookup_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts; see :func:`fingerprints`."""
    return fingerprints(documents(spark, folder))


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row per document: its fingerprint, that of its edited text, and likenesses; see the contract of op11.

    Null texts count as empty and are like other empty ones.  Documents without id come
    first; rows of one id are ordered by digest of the text, and the copies of a row follow each
    other.  Other columns are left out, whatever their names; an empty table gives an empty one.
    """
    rows = with_next_text(docs.select("doc_id", "text"))
    last = F.struct("next_text", F.lit(1).cast("long").alias("times"))
    others = F.struct(F.col("text").alias("next_text"), (F.col("copies") - 1).alias("times"))
    follows = F.explode(F.when(F.col("copies") > 1, F.array(others, last)).otherwise(F.array(last)))
    rows = rows.select("doc_id", "text", follows.alias("f")).select("doc_id", "text", "f.*")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select(
        "doc_id", "times", n.cast("long").alias("n_chars"), "text", edited.alias("edited"), "next_text"
    )
    texts = ("text", "edited", "next_text")
    keys = [paragraph_keys(F.col(c)).alias(c) for c in texts]
    rows = rows.select("doc_id", "times", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *keys)
    rows = rows.select("*", *[sketch(F.col(c)).alias(f"{c}_cells") for c in texts])
    pairs = [
        F.struct(
            F.col("text").alias("a"),
            F.col(other).alias("b"),
            F.col("text_cells").alias("cells_a"),
            F.col(f"{other}_cells").alias("cells_b"),
        )
        for other in texts[1:]
    ]
    rows = with_differences(rows.withColumn("pairs", F.array(*pairs)), "pairs", "found")
    rows = rows.select(
        "doc_id",
        "times",
        "n_chars",
        "edited_sha256",
        fingerprint_text(F.col("text_cells")).alias("fingerprint"),
        fingerprint_text(F.col("edited_cells")).alias("edited_fingerprint"),
        likeness(F.col("text"), F.col("found")[0]).alias("near_edited"),
        likeness(F.col("text"), F.col("found")[1]).alias("near_next"),
    )
    many = F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / COPIES)))
    rows = rows.select("*", many.alias("lot"))
    rest = F.least(F.lit(COPIES), F.col("times") - F.col("lot") * COPIES)
    return rows.select("*", F.explode(F.sequence(F.lit(1).cast("long"), rest)).alias("copy")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


# The sketches decode to what a plain comparison of keys gives.
OP11_SQL = f"""
WITH ordered AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars,
           row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(coalesce(text, ''))) AS n,
           count(*) OVER () AS total
    FROM documents
), linked AS (
    SELECT a.n, a.doc_id, a.n_chars::bigint AS n_chars, a.text AS own, b.text AS next,
           left(a.text, a.n_chars - a.n_chars // 2) || left(b.text, a.n_chars // 2) AS edited
    FROM ordered a JOIN ordered b ON b.n = a.n % a.total + 1
), paragraphs AS (
    SELECT n, 'own' AS side, unnest(regexp_extract_all(own, '{PARAGRAPH}')) AS p FROM linked
    UNION ALL SELECT n, 'edited', unnest(regexp_extract_all(edited, '{PARAGRAPH}')) FROM linked
    UNION ALL SELECT n, 'next', unnest(regexp_extract_all(next, '{PARAGRAPH}')) FROM linked
), keys AS (
    SELECT n, side, (('0x' || md5(p)[:15])::bigint + {PER_COPY} * (count(*) - 1)) % {KEYS} AS key
    FROM paragraphs GROUP BY n, side, md5(p)[:15]
), cells AS (
    SELECT n, side, (part * {WIDTH} + (key >> (20 * part)) % {WIDTH}) AS cell, count(*) AS keys,
           bit_xor(key) AS xors, bit_xor(key % {CHECK}) AS checks
    FROM keys, range({PARTS}) AS parts (part) GROUP BY ALL
), prints AS (
    SELECT n, side, string_agg(
        cell || ':' || keys || ':' || lower(to_hex(xors)) || ':' || lower(to_hex(checks)), ',' ORDER BY cell) AS print
    FROM cells GROUP BY n, side
), sizes AS (
    SELECT n, side, count(*) AS size FROM keys GROUP BY n, side
), shared AS (
    SELECT a.n, b.side, count(*) AS common
    FROM keys a JOIN keys b ON a.n = b.n AND a.key = b.key AND a.side = 'own' AND b.side <> 'own'
    GROUP BY a.n, b.side
), near AS (
    SELECT l.n, s.side, coalesce(common, 0) AS common,
           coalesce(o.size, 0) + coalesce(t.size, 0) - coalesce(common, 0) AS every
    FROM linked l CROSS JOIN (VALUES ('edited'), ('next')) AS s (side)
    LEFT JOIN sizes o ON o.n = l.n AND o.side = 'own'
    LEFT JOIN sizes t ON t.n = l.n AND t.side = s.side
    LEFT JOIN shared c ON c.n = l.n AND c.side = s.side
), likeness AS (
    SELECT n, side, CASE WHEN every = 0 THEN 1.0::double ELSE common::double / every END AS near FROM near
)
SELECT l.doc_id, l.n_chars, sha256(l.edited) AS edited_sha256,
       coalesce(o.print, '') AS fingerprint, coalesce(e.print, '') AS edited_fingerprint,
       ne.near AS near_edited, nn.near AS near_next
FROM linked l
LEFT JOIN prints o ON o.n = l.n AND o.side = 'own'
LEFT JOIN prints e ON e.n = l.n AND e.side = 'edited'
JOIN likeness ne ON ne.n = l.n AND ne.side = 'edited'
JOIN likeness nn ON nn.n = l.n AND nn.side = 'next'
"""
