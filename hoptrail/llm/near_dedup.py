"""Near-duplicate documents through SetSketch registers.

A document is the set of its word shingles. Its sketch holds, per register, the
minimum of exponentially distributed points of the shingles, truncated to an
exponential scale (so the maximum of two sketches is the sketch of the union).
Each shingle sends its points in ascending order to random registers and stops at
the largest minimum so far, which makes long documents cheap.

Bands of equal registers give candidates. Sizes that are too far apart, and lowest
bits of the registers that differ too often, rule a pair out while it is made. The
similarity of the others is estimated by maximum likelihood from the registers that
are larger, smaller and equal, given both set sizes; pairs far below the threshold
go. The rest is verified on the full shingle sets.

A bucket is not expanded into pairs. Documents with equal sets are one class from
the start. In a few rounds every member of a bucket is compared with one leader of
it, and links join components. Documents that share a bucket with another component
go on to an exact search: documents similar enough share one of their rarest
shingles, early enough among them, so all pairs of different components that do are
verified. A copy with many changes of its own has none to share, however large its
group, and makes no pairs.

Defined cases: null and empty texts have an empty set and link to nothing; fewer
words than a shingle count as one shingle; rows that share a doc_id are one
document as far as links go; rows without doc_id are kept and link to nothing; an
empty table gives an empty table. Only sizes and counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoptrail.llm import arrays
from hoptrail.llm.components import stars
from hoptrail.llm.spool import only_ids, passing, spool
from hoptrail.llm.workers import ship

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80
REGISTERS = 256
BAND_ROWS = 6
BASE = 1.001
RATE = 20.0
TOP = (1 << 16) - 1
# Five standard deviations of the estimate at the threshold.
MARGIN = 0.13
LEADER_ROUNDS = 2

LOW_BITS = tuple(f"low{i}" for i in range(REGISTERS // 64))

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def shingle_hashes(piece: arrays.Piece, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text with A-Z lowered, and their text numbers."""
    start, end, text = arrays.words(piece)
    word = arrays.span_hashes(arrays.prefix_sums(arrays.LOWER[piece.data]), start, end)
    found, at = arrays.sequences(word, text, words)
    owner = text[at]
    counts = np.bincount(text, minlength=len(piece))
    for n in range(1, words):
        few, first = arrays.sequences(word, text, n)
        whole = counts[text[first]] == n
        found = np.concatenate([found, arrays.mix(few[whole] + _U(n))])
        owner = np.concatenate([owner, text[first][whole]])
    keys = arrays.mix(found + owner.astype(_U) * _U(0xD6E8FEB86659FD93))
    once = np.sort(np.unique(keys, return_index=True)[1])
    found, owner = found[once], owner[once]
    order = np.argsort(owner, kind="stable")
    return found[order], owner[order]


def smallest_points(hashes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """The least point of each register of each text; infinite for an empty set.

    A shingle's points form a Poisson process spread evenly over the registers."""
    least = np.full(texts * REGISTERS, np.inf)
    bound = np.full(texts, np.inf)
    state, x = hashes.copy(), np.zeros(len(hashes))
    while len(state):
        block = int(np.clip(16384 // len(state), 1, 64))
        steps = state[:, None] + np.arange(1, block + 1, dtype=_U) * _STEP
        draws = arrays.mix(steps)
        gaps = -np.log(((draws >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53) / REGISTERS
        points = np.cumsum(np.concatenate([x[:, None], gaps], axis=1), axis=1)[:, 1:]
        registers = owner[:, None] * REGISTERS + (draws & _U(REGISTERS - 1)).astype(np.int64)
        np.minimum.at(least, registers.ravel(), points.ravel())
        touched = owner[np.flatnonzero(np.diff(owner, prepend=-1))]
        bound[touched] = least.reshape(texts, REGISTERS)[touched].max(axis=1)
        going = points[:, -1] < bound[owner]
        state, x, owner = steps[going, -1], points[going, -1], owner[going]
    return least.reshape(texts, REGISTERS)


def truncate(points: np.ndarray) -> np.ndarray:
    """Points on the exponential scale: larger values for smaller points."""
    with np.errstate(divide="ignore"):
        scaled = np.floor(1.0 + (np.log(RATE) - np.log(points)) / np.log(BASE))
    return np.clip(np.where(np.isinf(points), 0, scaled), 0, TOP).astype(np.uint16)


def _sums(values: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    held = np.concatenate([[_U(0)], np.cumsum(values, dtype=_U)])
    cuts = np.searchsorted(owner, np.arange(texts + 1))
    return (held[cuts[1:]] - held[cuts[:-1]]).view(np.int64)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, set size ``n``, a digest (``d1``, ``d2``) of the set, registers."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in arrays.pieces(batch.column("text")):
                n = len(piece)
                found, owner = shingle_hashes(piece, words)
                registers = truncate(smallest_points(found, owner, n))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(piece.first, n),
                        pa.array(np.bincount(owner, minlength=n)),
                        pa.array(_sums(arrays.mix(found), owner, n)),
                        pa.array(_sums(arrays.mix(found ^ _STEP), owner, n)),
                        pa.array([row.tobytes() for row in registers], pa.binary()),
                        *(pa.array(x) for x in np.packbits(registers & 1, axis=1).view(np.int64).T.copy()),
                    ],
                    ["doc_id", "n", "d1", "d2", "registers", *LOW_BITS],
                )

    low = ", ".join(f"{c} long" for c in LOW_BITS)
    return docs.select("doc_id", "text").mapInArrow(
        sketch, f"doc_id long, n long, d1 long, d2 long, registers binary, {low}"
    )


def parts(batches: Iterator[pa.RecordBatch], most: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows, which keeps the matrices made of them small."""
    for batch in batches:
        for first in range(0, batch.num_rows, most):
            yield batch.slice(first, most)


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def bands(classes: DataFrame) -> DataFrame:
    """One row per class and band of registers."""
    count = REGISTERS // BAND_ROWS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            rows = _rows(batch.column("registers"))[:, : count * BAND_ROWS].reshape(-1, count, BAND_ROWS)
            key = np.broadcast_to(np.arange(1, count + 1, dtype=_U), rows.shape[:2])
            for i in range(BAND_ROWS):
                key = arrays.mix(key * _U(0xFF51AFD7ED558CCD) + rows[:, :, i].astype(_U))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(batch.column("rep").to_numpy(), count))],
                ["band", "rep"],
            )

    return classes.select("rep", "registers").mapInArrow(cut, "band long, rep long")


def likely_similarity(rows_a: np.ndarray, rows_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from register comparisons, on a grid."""
    greater = (rows_a > rows_b).sum(axis=1)[:, None]
    less = (rows_a < rows_b).sum(axis=1)[:, None]
    equal = rows_a.shape[1] - greater - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1.0 - u
    grid = np.linspace(0.0, 1.0, 101)[None, :] * np.minimum(u / v, v / u)
    chance = lambda x: -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)
    over, under = chance(u - v * grid), chance(v - u * grid)
    logs = lambda n, p: np.where(n > 0, n * np.log(np.maximum(p, 1e-12)), 0.0)
    score = logs(greater, over) + logs(less, under) + logs(equal, 1 - over - under)
    return grid[np.arange(len(grid)), score.argmax(axis=1)]


def promising(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose estimated similarity may reach the threshold."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            sizes = [batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b")]
            found = likely_similarity(_rows(batch.column("r_a")), _rows(batch.column("r_b")), *sizes)
            yield batch.select(["a", "b"]).filter(pa.array(found >= percent / 100 - MARGIN))

    side = lambda x: classes.selectExpr(f"rep as {x}", f"n as n_{x}", f"registers as r_{x}")
    sized = pairs.join(side("a"), "a").where(F.col("n_a").isNotNull()).join(side("b"), "b")
    sized = sized.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    return sized.mapInArrow(judge, "a long, b long")


def shingle_set(text: str, words: int) -> set[tuple[bytes, ...]]:
    found = text.encode().translate(arrays.LOWER.tobytes()).split()
    if len(found) < words:
        return {tuple(found)} if found else set()
    return set(zip(*(found[i:] for i in range(words))))


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets are similar enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, keep = (None, None), []
            for a, b in zip(batch.column("t_a").to_pylist(), batch.column("t_b").to_pylist()):
                if known[0] != a:
                    known = a, shingle_set(a, words)
                one, other = known[1], shingle_set(b, words)
                shared = len(one & other)
                keep.append(100 * shared >= percent * (len(one) + len(other) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ids = spool(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    texts = only_ids(docs.select("doc_id", "text").where("text is not null"), ids, "doc_id")
    both = pairs.join(texts.selectExpr("doc_id as a", "text as t_a"), "a").join(
        texts.selectExpr("doc_id as b", "text as t_b"), "b"
    )
    return both.mapInArrow(compare, "a long, b long")


def _with_component(members: DataFrame, known: DataFrame | None) -> DataFrame:
    if known is None:
        return members.withColumn("component", F.col("rep"))
    found = known.withColumnRenamed("node", "rep")
    return members.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _ordered(first: str, second: str) -> list:
    return [F.least(first, second).alias("a"), F.greatest(first, second).alias("b")]


def _may_link(percent: int) -> str:
    """Condition on a member and another one (``o_`` columns): sizes allow the
    similarity, and the lowest bits of the registers do not speak against it. Equal
    registers have equal bits and others do half of the time, so the bits that
    differ are few at the threshold; five standard deviations more are let through."""
    share = (1 - percent / 100) / 2
    most = int(REGISTERS * share + 5 * (REGISTERS * share * (1 - share)) ** 0.5) + 1
    apart = " + ".join(f"bit_count({c} ^ o_{c})" for c in LOW_BITS)
    return f"100 * least(n, o_n) >= {percent} * greatest(n, o_n) and {apart} <= {most}"


def _others(members: DataFrame, *more: str) -> DataFrame:
    own = ("rep", "component", "n", *LOW_BITS, *more)
    return members.select("band", *(F.col(c).alias(f"o_{c}") for c in own))


def leader_pairs(members: DataFrame, turn: int, percent: int) -> DataFrame:
    """Every bucket member beside the bucket's leader, if they are not joined yet."""
    own = ["rep", "component", "n", *LOW_BITS]
    leaders = (
        members.groupBy("band")
        .agg(
            F.min(F.struct(F.xxhash64("rep", F.lit(turn)).alias("turn"), *own)).alias("leader"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        .where("low < high")
        .select("band", *(F.col(f"leader.{c}").alias(c) for c in own))
    )
    beside = members.join(_others(leaders), "band").where(f"component <> o_component and {_may_link(percent)}")
    return beside.select(*_ordered("rep", "o_rep")).distinct()


def open_buckets(members: DataFrame) -> DataFrame:
    """Members of buckets with several components, and the largest of these (``main``)."""
    parts = members.groupBy("band", "component").agg(F.count("*").alias("size"))
    main = (
        parts.groupBy("band")
        .agg(F.max(F.struct("size", "component")).alias("main"), F.count("*").alias("parts"))
        .where("parts > 1")
        .selectExpr("band", "main.component as main")
    )
    return members.join(main, "band")


def leading_shingles(nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The shingles of each document that every link to another component must share
    one of, as ``band``.

    All shingles get one order: those of a single component first, then from rare to
    common. Two sets similar enough share so many of their shingles that they share
    one of the first ``n - percent * n / 100 + 1`` of either."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = (batch.column(c).to_numpy() for c in ("doc_id", "component"))
            for piece in arrays.pieces(batch.column("text")):
                found, owner = shingle_hashes(piece, words)
                at = piece.first + owner
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(ids[at]), pa.array(parts[at])],
                    ["band", "rep", "component"],
                )

    ids = nodes.select(F.col("rep").alias("doc_id"), "component")
    texts = only_ids(docs.select("doc_id", "text").where("text is not null"), ids.select("doc_id"), "doc_id")
    rows = texts.join(ids, "doc_id").select("doc_id", "component", "text")
    rows = spool(rows.mapInArrow(cut, "band long, rep long, component long").select("band", "rep", "component"))
    spread = rows.groupBy("band").agg(
        F.count("*").alias("texts"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    several = spread.where("low < high").select("band", "texts")
    ordered = Window.partitionBy("rep").orderBy("texts", "band")
    ranked = rows.select("band", "rep").join(several, "band").select(
        "band",
        "rep",
        F.row_number().over(ordered).alias("place"),
        F.count("*").over(Window.partitionBy("rep")).alias("shareable"),
    )
    found = ranked.join(nodes, "rep").withColumn("place", F.expr("n - shareable + place"))
    return found.where(f"place <= n - ceil({percent} * n / 100) + 1").drop("shareable")


def open_pairs(members: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """All pairs in different components that may be linked, of the documents that
    share a bucket with another component."""
    spread = members.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    several = members.join(spread.where("low < high"), "band", "left_semi")
    nodes = spool(several.select("rep", "component", "n", *LOW_BITS).distinct())
    held = spool(open_buckets(leading_shingles(nodes, docs, words, percent)))
    # Before their first common shingle the two share nothing, and behind it at most
    # what is left of the shorter rest.
    left = f"(1 + least(n - place, o_n - o_place)) * {100 + percent} >= {percent} * (n + o_n)"
    return (
        held.join(_others(held.where("component <> main"), "place"), "band")
        .where(f"component <> o_component and (component = main or rep < o_rep) and {left} and {_may_link(percent)}")
        .select(*_ordered("rep", "o_rep"))
        .distinct()
    )


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every document."""
    ship(docs.sparkSession)
    with passing() as held:
        sketched = spool(sketches(docs, words))
        classes = spool(
            sketched.where("n > 0 and doc_id is not null")
            .groupBy("n", "d1", "d2")
            .agg(F.min(F.struct("doc_id", "registers", *LOW_BITS)).alias("first"), F.count("*").alias("copies"))
            .select(F.col("first.doc_id").alias("rep"), "n", "d1", "d2", "copies", "first.registers",
                    *(F.col(f"first.{c}").alias(c) for c in LOW_BITS))
        )
        all_members = bands(classes)
        shared = all_members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1").select("band")
        members = spool(all_members.join(shared, "band").join(classes.select("rep", "n", *LOW_BITS), "rep"))
        known = tried = None
        for turn in range(LEADER_ROUNDS + 1):
            tagged = _with_component(members, known)
            pairs = leader_pairs(tagged, turn, percent) if turn < LEADER_ROUNDS else open_pairs(tagged, docs, words, percent)
            if tried is not None:
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
            if turn < LEADER_ROUNDS:
                pairs = spool(pairs)
                tried = pairs if tried is None else tried.union(pairs)
            found = spool(verified(spool(promising(pairs, classes, percent)), docs, words, percent))
            known = stars(found if known is None else known.toDF("a", "b").union(found))
        held += [sketched, classes, known]
    copies = classes.where("copies > 1").select("n", "d1", "d2", "rep")
    joined = sketched.select("doc_id", "n", "d1", "d2").join(copies, ["n", "d1", "d2"], "left")
    joined = _with_component(joined.withColumn("rep", F.coalesce("rep", "doc_id")), known)
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"),
    )
