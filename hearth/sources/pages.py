"""Web pages to records (one a page) and cards (many a page), on Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from hearth.functions import markup
from hearth.functions.markup import Field

SLICE = 64  # pages that are read before their records leave


def records(pages: DataFrame, key: str, page: str, fields: list[Field], card: str | None = None) -> DataFrame:
    """``key`` and the fields of every page; with ``card`` also ``position``, for every element on that path.

    A field of the first element is a text, null where there is none; a field of every element is an array.  A null page is
    an empty one: one record without values, no cards.
    """
    kinds = dict(pages.dtypes)
    names = [f"`{key}` {kinds[key]}", *(["position int"] if card else []), *[f"`{f.name}` {'array<string>' if f.every else 'string'}" for f in fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.list_(pa.string()) if f.every else pa.string() for f in fields]
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                found = [markup.read(p, fields, card) for p in part.column(1).to_pylist()]
                rows = [(i, k, r) for i, rs in enumerate(found) for k, r in enumerate(rs)]
                values = [pa.array([r.get(f.name, []) if f.every else next(iter(r.get(f.name, [])), None) for _, _, r in rows], t) for f, t in zip(fields, types, strict=True)]
                place = [pa.array([k for _, k, _ in rows], pa.int32())] if card else []
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array([i for i, _, _ in rows], pa.int64())), *place, *values], names=[n.split()[0].strip("`") for n in names])

    return pages.select(key, page).mapInArrow(run, ", ".join(names))
