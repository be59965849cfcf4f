"""Taking byte spans out of documents."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal spans; those that overlap or touch become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def cut_spans(
    docs: DataFrame, found: DataFrame, fields: list[str], tell: Callable[..., list[tuple[int, int]]]
) -> DataFrame:
    """Every document without the spans that ``tell`` makes of the fields of its
    ``spans`` in ``found``. Texts meet their spans by one shuffle of both. A document's
    spans are one list, as its text is one value."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lists = [], batch.column("spans")
            for i, text in enumerate(batch.column("text").to_pylist()):
                data = (text or "").encode()
                gone: list[tuple[int, int]] = []
                if lists[i].is_valid:
                    columns: list[np.ndarray] = [lists[i].values.field(c).to_numpy() for c in fields]
                    gone = [(a, min(b, len(data))) for a, b in tell(*columns) if a < len(data)]
                kept, at = [], 0
                for a, b in gone:
                    kept.append(data[at:a])
                    at = b
                left = b"".join([*kept, data[at:]])
                rows.append((len(data), len(data) - len(left), len(gone), hashlib.sha256(left).hexdigest(), left))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return docs.select("doc_id", "text").join(found, "doc_id", "left").mapInArrow(cut, _SCHEMA)
