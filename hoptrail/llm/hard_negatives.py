"""Hard-negative mining with angular triangle filtering.

Every row stores its norm and its angles to a few reference directions. The angle of
two rows lies between the largest difference and the smallest sum of their angles to
any reference, so the angles give an interval of cosines and, times the norms, one of
scores. Rows lie sorted by label, nearest reference and angle to it; a window of
``WINDOW`` neighbours has a span of angles and norms, hence one interval per anchor.
Only windows whose interval, widened beyond all rounding, reaches what is asked for
get scored, exactly, in whole numbers.

Anchors are the query set and grow with the data, so they are taken in slices of at
most ``SLICE``, held by the size of their files. Each slice is broadcast and goes over
all rows where they lie, first for positives and then for negatives. Before that the
slice is searched in itself: the scores found there are floors that all tasks know.
A task keeps the best few per anchor, and tasks are merged by a window. What a slice
collects is its anchors, their positives and floors, a fixed number per anchor.

Defined cases: rows whose vec_id, label or vector is null, or that have a null or
non-finite component, take no part. A row is never its own positive, a repeat of it
is. Missing components of shorter vectors count as 0. Scores that may leave 52 bits
are computed with unbounded integers; one of 2^62 and more ends the job with an error. Without anchors, positives or negatives there are no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hoptrail.llm.centroids import whole_vectors
from hoptrail.llm.spool import discard, spool
from hoptrail.llm.workers import ship

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LEAST_PERCENT, MOST_PERCENT = 50, 95
REFERENCES = 16
WINDOW_BITS = 9
WINDOW = 1 << WINDOW_BITS
SLICE = 16_384
ANCHORS_AT_ONCE = 2_048

_NONE = -(1 << 62)
_LAST = (1 << 63) - 1
_ANGLE_SLACK, _SCORE_SLACK = 1e-7, 1e-9
_PLACED = "row long, vec_id long, label int, v array<long>, norm double, angles array<double>, cell int, near double"
_FOUND = "anchor int, slot int, score long, vec_id long"


def padded(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of a matrix, filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), values.dtype)
    out[np.arange(width)[None] < sizes[:, None]] = values
    return out


def angles_to(v: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    cosines = (v @ references.T) / np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(cosines, -1.0, 1.0))


@dataclass
class Rows:
    """Vectors of one slice or window, with what the filter needs."""

    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    v: np.ndarray
    norm: np.ndarray
    angles: np.ndarray

    @staticmethod
    def of(table: pa.Table | pa.RecordBatch, width: int, references: int) -> Rows:
        column = lambda c: (x.combine_chunks() if isinstance(x := table.column(c), pa.ChunkedArray) else x)
        plain = [column(c).to_numpy(zero_copy_only=False) for c in ("row", "vec_id", "label")]
        angles = column("angles").flatten().to_numpy(zero_copy_only=False).reshape(-1, references)
        return Rows(*plain, padded(column("v"), width), column("norm").to_numpy(), angles)

    def __len__(self) -> int:
        return len(self.row)

    def take(self, at) -> Rows:
        return Rows(self.row[at], self.vec_id[at], self.label[at], self.v[at], self.norm[at], self.angles[at])

    def windows(self, size: int = WINDOW) -> Iterator[Rows]:
        """Neighbours of one label, in order of vec_id."""
        edges = np.flatnonzero(np.diff(self.label, prepend=self.label[:1] - 1)) if len(self) else []
        for begin, end in zip(edges, [*edges[1:], len(self)]):
            for first in range(begin, end, size):
                part = self.take(slice(first, min(end, first + size)))
                yield part.take(np.argsort(part.vec_id, kind="stable"))


def score_bounds(anchors: Rows, window: Rows) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest score that any row of the window can have, per anchor."""
    low, high = window.angles.min(axis=0), window.angles.max(axis=0)
    apart = np.maximum(low - anchors.angles, anchors.angles - high).max(axis=1)
    about = np.minimum(anchors.angles + high, 2 * math.pi - anchors.angles - low).min(axis=1)
    cos_high = np.cos(np.clip(apart - _ANGLE_SLACK, 0.0, math.pi))
    cos_low = np.cos(np.clip(about + _ANGLE_SLACK, 0.0, math.pi))
    least, most = window.norm.min(), window.norm.max()
    slack = 1.0 + _SCORE_SLACK * anchors.norm * most
    return (
        anchors.norm * np.minimum(cos_low * least, cos_low * most) - slack,
        anchors.norm * np.maximum(cos_high * least, cos_high * most) + slack,
    )


def exact_keys(anchors: Rows, window: Rows) -> np.ndarray:
    """Integer scores and, below them, a rank that puts smaller vec_ids first."""
    largest = int(np.abs(anchors.v).max(initial=0)), int(np.abs(window.v).max(initial=0))
    if largest[0] * largest[1] * max(1, anchors.v.shape[1]) < 1 << 52:
        scores = (anchors.v.astype(float) @ window.v.astype(float).T).astype(np.int64)
    else:
        scores = anchors.v.astype(object) @ window.v.astype(object).T
        if scores.size and max(scores.max(), -scores.min()) >= -_NONE:
            raise ValueError("scores must be below 2^62")
    return scores * WINDOW + (WINDOW - 1 - np.arange(len(window)))


def no_key(keys: np.ndarray) -> int:
    """Below every key of an array from ``exact_keys``."""
    return _NONE << WINDOW_BITS if keys.dtype == object else _NONE


class Best:
    """The best few (score, vec_id) per anchor and slot, above a floor."""

    def __init__(self, anchors: int, slots: int, most: int, floors: np.ndarray | None):
        self.most = most
        self.score = np.full((anchors, slots, most), _NONE)
        self.vec_id = np.full((anchors, slots, most), _LAST)
        self.floor = np.full((anchors, slots), _NONE) if floors is None else floors

    def need(self) -> np.ndarray:
        """Scores below this change nothing any more, per anchor and slot."""
        return np.maximum(self.floor, self.score[:, :, -1])

    def add(self, at: np.ndarray, slot: int, keys: np.ndarray, window: Rows) -> None:
        most = min(self.most, keys.shape[1])
        if keys.dtype == object:
            top = np.sort(keys, axis=1)[:, -most:]
        else:
            top = np.partition(keys, keys.shape[1] - most, axis=1)[:, -most:]
        empty = top == no_key(keys)
        scores = np.where(empty, _NONE, top >> WINDOW_BITS).astype(np.int64)
        ids = np.where(empty, _LAST, window.vec_id[WINDOW - 1 - (np.where(empty, WINDOW - 1, top) & (WINDOW - 1)).astype(int)])
        scores = np.concatenate([self.score[at, slot], scores], axis=1)
        ids = np.concatenate([self.vec_id[at, slot], ids], axis=1)
        order = np.lexsort((ids, -scores), axis=1)[:, : self.most]
        self.score[at, slot] = np.take_along_axis(scores, order, axis=1)
        self.vec_id[at, slot] = np.take_along_axis(ids, order, axis=1)

    def rows(self) -> pa.RecordBatch:
        anchor, slot, place = np.nonzero((self.score > _NONE) & (self.score >= self.floor[:, :, None]))
        columns = [anchor.astype(np.int32), slot.astype(np.int32)]
        columns += [self.score[anchor, slot, place], self.vec_id[anchor, slot, place]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "slot", "score", "vec_id"])


def best_positives(window: Rows, anchors: Rows, best: Best) -> int:
    """Take in the rows of a window that have the anchor's label. Gives the number of
    scores computed."""
    low, high = score_bounds(anchors, window)
    chosen = np.flatnonzero((anchors.label == window.label[0]) & (high >= best.need()[:, 0]))
    order = np.argsort(window.row)
    for first in range(0, len(chosen), ANCHORS_AT_ONCE):
        at = chosen[first : first + ANCHORS_AT_ONCE]
        keys = exact_keys(anchors.take(at), window)
        place = order[np.searchsorted(window.row, anchors.row[at], sorter=order) % len(window)]
        own = np.flatnonzero(window.row[place] == anchors.row[at])
        keys[own, place[own]] = no_key(keys)
        best.add(at, 0, keys, window)
    return len(chosen) * len(window)


def best_negatives(window: Rows, anchors: Rows, best: Best, least: np.ndarray, most: np.ndarray) -> int:
    """Take in the rows of a window that have another label and a score from ``least``
    to ``most``, per anchor and slot."""
    low, high = score_bounds(anchors, window)
    overlaps = (high[:, None] >= np.maximum(least, best.need())) & (low[:, None] <= most) & (least <= most)
    chosen = np.flatnonzero((anchors.label != window.label[0]) & overlaps.any(axis=1))
    for first in range(0, len(chosen), ANCHORS_AT_ONCE):
        at = chosen[first : first + ANCHORS_AT_ONCE]
        keys = exact_keys(anchors.take(at), window)
        for slot in range(least.shape[1]):
            bottom, top = (x[at, slot][:, None].astype(keys.dtype) for x in (least, most))
            inside = (keys >= bottom * WINDOW) & (keys < (top + 1) * WINDOW)
            best.add(at, slot, np.where(inside, keys, no_key(keys)), window)
    return len(chosen) * len(window)


def placed(vectors: DataFrame, references: np.ndarray, width: int) -> DataFrame:
    """Rows with norms and angles, in the order of the windows."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = padded(batch.column("v"), width).astype(float)
            norms = np.sqrt((v * v).sum(axis=1))
            angles = angles_to(v, norms, references)
            cell = angles.argmin(axis=1)
            starts = pa.array(np.arange(0, angles.size + 1, angles.shape[1], dtype=np.int32))
            more = [norms, pa.ListArray.from_arrays(starts, pa.array(angles.ravel()))]
            more += [cell.astype(np.int32), angles[np.arange(len(v)), cell]]
            columns = [batch.column(c) for c in ("row", "vec_id", "label", "v")]
            names = ["row", "vec_id", "label", "v", "norm", "angles", "cell", "near"]
            yield pa.RecordBatch.from_arrays([*columns, *(m if isinstance(m, pa.Array) else pa.array(m) for m in more)], names)

    order = ["label", "cell", "near", "vec_id", "row"]
    found = vectors.mapInArrow(place, _PLACED)
    return found.repartitionByRange(*order).sortWithinPartitions(*order)


def reference_directions(rows: DataFrame, number: int, width: int) -> np.ndarray:
    """The directions of a few rows, those with the smallest hash of their id."""
    picked = (
        rows.where(F.exists("v", lambda x: x != 0)).orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(number)
    )
    found = [np.pad(np.array(r["v"], float), (0, width - len(r["v"]))) for r in picked.select("v").collect()]
    if not found:
        return np.eye(1, max(width, 1))[:, :width]
    return np.array([v / np.sqrt(v @ v) for v in found])


class Search:
    """One slice of anchors against tables of placed rows."""

    def __init__(self, spark: SparkSession, anchors: Rows, width: int, references: int):
        self.spark, self.anchors = spark, anchors
        self.width, self.references = width, references
        self.shared = spark.sparkContext.broadcast(anchors)

    def scan(self, rows: DataFrame, slots: int, most: int, floors, limits=None) -> DataFrame:
        """The best rows per anchor and slot over ``rows``, ranked from 1."""
        width, references, shared = self.width, self.references, self.shared
        bounds = self.spark.sparkContext.broadcast((floors, limits))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors, (floors, limits) = shared.value, bounds.value
            best = Best(len(anchors), slots, most, floors)
            for batch in batches:
                for window in Rows.of(batch, width, references).windows():
                    if limits is None:
                        best_positives(window, anchors, best)
                    else:
                        best_negatives(window, anchors, best, *limits)
            yield best.rows()

        found = rows.select("row", "vec_id", "label", "v", "norm", "angles").mapInArrow(search, _FOUND)
        order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    def floors(self, found: DataFrame, slots: int, most: int) -> np.ndarray:
        """Scores that enough rows reach already."""
        out = np.full((len(self.anchors), slots), _NONE)
        table = found.where(F.col("rank") == most).select("anchor", "slot", "score").toArrow()
        at = table["anchor"].to_numpy(), table["slot"].to_numpy()
        out[at] = table["score"].to_numpy()
        return out

    def both_passes(self, own: DataFrame, rows: DataFrame, positives: int, negatives: int, percent) -> DataFrame:
        floors = self.floors(self.scan(own, 1, positives, None), 1, positives)
        chosen = spool(self.scan(rows, 1, positives, floors))
        table = chosen.select("anchor", "rank", "score").toArrow()
        at = table["anchor"].to_numpy(), table["rank"].to_numpy() - 1
        least = np.full((len(self.anchors), positives), 1)
        most = np.full((len(self.anchors), positives), 0)
        score = table["score"].to_numpy().astype(object)
        least[at], most[at] = -(-percent[0] * score // 100), percent[1] * score // 100
        floors = self.floors(self.scan(own, positives, negatives, None, (least, most)), positives, negatives)
        found = self.scan(rows, positives, negatives, floors, (least, most))
        names = F.broadcast(
            self.spark.createDataFrame(
                pa.table({"anchor": np.arange(len(self.anchors), dtype=np.int32), "anchor_id": self.anchors.vec_id})
            )
        )
        chosen = chosen.select(
            "anchor", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        return found.join(chosen, ["anchor", "slot"]).join(names, "anchor").select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )


def mine_negatives(
    vectors: DataFrame,
    is_anchor: str = "vec_id % 50 = 0",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: tuple[int, int] = (LEAST_PERCENT, MOST_PERCENT),
    scale: int = SCALE,
    references: int = REFERENCES,
    slice_rows: int = SLICE,
) -> DataFrame:
    """For each anchor and each of its best rows of the same label, the best rows of
    other labels whose score lies within the given percentages of the positive's."""
    spark = ship(vectors.sparkSession)
    rows = (
        whole_vectors(vectors.select("vec_id", "label", "embedding"), scale)
        .where("vec_id is not null and label is not null")
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", F.col("label").cast("int").alias("label"), "v")
    )
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    directions = reference_directions(rows, references, width)
    table = spool(placed(rows, directions, width))
    anchors = table.where(is_anchor)
    number = anchors.count()
    out = []
    if number:
        anchors = spool(anchors.repartition(math.ceil(number / (0.9 * slice_rows))), maxRecordsPerFile=slice_rows)
        for file in sorted(anchors.inputFiles()):
            own = spark.read.schema(anchors.schema).parquet(file)
            held = Rows.of(own.orderBy("vec_id", "row").toArrow(), width, len(directions))
            if len(held):
                search = Search(spark, held, width, len(directions))
                out.append(spool(search.both_passes(own, table, positives, negatives, percent)))
        discard(anchors)
    discard(table)
    if not out:
        schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], schema)
    return spark.read.schema(out[0].schema).parquet(*(t._spooled_at for t in out))
