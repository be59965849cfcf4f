"""Benchmark passages in documents: SimHash of item-sized windows.

For every benchmark item, windows of as many words slide over the documents. A
window can only resemble an item if they share a shingle, and sliding it on to its
first shared shingle loses none, so only windows that start at a shingle of an item
of their size (or end with the document) are looked at.

Each window gets a 64-bit SimHash of its shingles. The fingerprint is cut into four
blocks of 16 bits; two fingerprints within a radius of 15 differ by 3 bits at most in
one of them. So every item stands under all 697 values near each of its blocks, every
window under its own four, and a join finds all pairs within the radius, and of other
pairs some 4 in 100. What is within the radius is verified with the exact weighted
Jaccard similarity of the shingles, weighted by their counts.

Windows with the same words are compared once, so a passage that a third of all
documents quote costs no more than one. Everything is built-in functions.

Words are runs of letters and digits of the lowered text. Defined cases: null and
empty texts and items match nothing; an item with fewer words than a shingle is too
short to tell anything and is never reported; a document shorter than an item is one
window; repeated rows are each searched, and repeated items too; rows without
doc_id or item_id are left out; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.llm.spool import only_ids, spool

SHINGLE_WORDS = 5
LEAST_SIMILARITY = 0.8
RADIUS = 15
BITS, BLOCK_BITS = 64, 16


def _words(column: str) -> str:
    return f"array_remove(split(lower({column}), r'[^\\p{{L}}\\p{{N}}]+'), '')"


def _shingle_hashes(words: str, n: int) -> str:
    """Hashes of all runs of n words; none if there are fewer words."""
    return f"""if(size({words}) < {n}, cast(array() as array<bigint>),
        transform(sequence(1, greatest(size({words}) - {n - 1}, 1)), i -> xxhash64(slice({words}, i, {n}))))"""


def _simhash(hashes: str) -> str:
    return f"""aggregate(sequence(0, {BITS - 1}), 0L, (found, bit) -> found | if(
        2 * aggregate({hashes}, 0L, (n, h) -> n + (shiftright(h, bit) & 1L)) > size({hashes}),
        shiftleft(1L, bit), 0L))"""


def _blocks(fingerprint: str) -> str:
    """The fingerprint in blocks, as (number, value)."""
    low = (1 << BLOCK_BITS) - 1
    parts = [
        f"named_struct('block', {i}, 'value', shiftrightunsigned({fingerprint}, {i * BLOCK_BITS}) & {low}L)"
        for i in range(BITS // BLOCK_BITS)
    ]
    return f"inline(array({', '.join(parts)}))"


def _near_blocks(table: DataFrame, radius: int) -> DataFrame:
    """Rows of ``table`` under every value that a block of a fingerprint within the
    radius has in at least one place."""
    most = radius // (BITS // BLOCK_BITS)
    flips = f"filter(sequence(0L, {(1 << BLOCK_BITS) - 1}L), flip -> bit_count(flip) <= {most})"
    rest = [c for c in table.columns if c != "value"]
    return table.selectExpr(*rest, f"explode(transform({flips}, flip -> value ^ flip)) as value")


def _counted_shingles(words: str, n: int) -> str:
    """The shingles of a word list as a set that keeps their counts: the second and
    later occurrences of a shingle carry their number."""
    return f"""aggregate(
        array(transform(sequence(1, size({words}) - {n - 1}), i -> concat_ws(' ', slice({words}, i, {n})))),
        cast(array() as array<string>),
        (none, all) -> if(size(array_distinct(all)) = size(all), all, transform(all, (s, i) -> concat(
            s, ' ', size(filter(slice(all, 1, i + 1), x -> x = s))))))"""


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    shingle: int = SHINGLE_WORDS,
    least: float = LEAST_SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """``doc_id``, ``item_id``, the best ``similarity`` of a window of the document to
    the item, and ``first_word``, the first start looked at of a window that reaches
    it."""
    known = spool(
        items.where("item_id is not null")
        .selectExpr("item_id", f"{_words('text')} as item_words")
        .where(f"size(item_words) >= {shingle}")
        .selectExpr(
            "item_id", "item_words", "size(item_words) as width", f"{_shingle_hashes('item_words', shingle)} as hashes"
        )
    )
    sought = spool(known.select("width", F.explode("hashes").alias("hash")).distinct())
    texts = docs.where("doc_id is not null and text is not null").selectExpr("doc_id", f"{_words('text')} as words")
    starts = (
        texts.selectExpr("doc_id", "size(words) as n", f"posexplode({_shingle_hashes('words', shingle)}) as (at, hash)")
        .join(sought, "hash")
        .selectExpr("doc_id", "greatest(least(at, n - width), 0) as at", "width")
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("at", "width")).alias("places"))
    )
    starts = spool(starts)
    hit = only_ids(docs.select("doc_id", "text"), spool(starts.select("doc_id")), "doc_id")
    windows = (
        hit.join(starts, "doc_id")
        .selectExpr("doc_id", f"{_words('text')} as all_words", "places")
        .selectExpr(
            "doc_id",
            """inline(transform(places, p -> named_struct(
                'at', p.at, 'width', p.width, 'words', slice(all_words, p.at + 1, p.width))))""",
        )
        .where(f"size(words) >= {shingle}")
        .selectExpr("*", "xxhash64(words) as one", "xxhash64(width, words, 1) as two")
    )
    windows = spool(windows)
    distinct = spool(
        windows.groupBy("one", "two", "width")
        .agg(F.min("words").alias("words"))
        .selectExpr("*", f"{_shingle_hashes('words', shingle)} as hashes")
        .selectExpr(
            "one", "two", "width", f"{_simhash('hashes')} as mark", f"{_counted_shingles('words', shingle)} as own"
        )
    )
    marked = spool(
        known.selectExpr(
            "item_id",
            "width",
            f"{_simhash('hashes')} as item_mark",
            f"{_counted_shingles('item_words', shingle)} as sought",
        )
    )
    blocks = spool(_near_blocks(marked.selectExpr("item_id", "width", "item_mark", _blocks("item_mark")), radius))
    near = (
        distinct.selectExpr("one", "two", "width", "mark", _blocks("mark"))
        .join(blocks, ["width", "block", "value"])
        .where(f"bit_count(mark ^ item_mark) <= {radius}")
        .select("one", "two", "width", "item_id")
        .distinct()
    )
    alike = (
        spool(near)
        .join(distinct.select("one", "two", "width", "own"), ["one", "two", "width"])
        .join(marked.select("item_id", "width", "sought"), ["item_id", "width"])
        .withColumn("shared", F.size(F.array_intersect("own", "sought")).cast("double"))
        .selectExpr(
            "one", "two", "width", "item_id", "shared / (size(own) + size(sought) - shared) as similarity"
        )
        .where(f"similarity >= {least}")
        .groupBy("one", "two", "width", "item_id")
        .agg(F.max("similarity").alias("similarity"))
    )
    return (
        windows.select("doc_id", "at", "one", "two", "width")
        .join(alike, ["one", "two", "width"])
        .groupBy("doc_id", "item_id")
        .agg(F.max("similarity").alias("similarity"), F.max(F.struct("similarity", -F.col("at"))).alias("best"))
        .selectExpr("doc_id", "item_id", "similarity", "cast(-best.col2 as bigint) as first_word")
    )
