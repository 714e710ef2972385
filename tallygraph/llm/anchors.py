"""Which winnowed anchors occur more than once, for both substring operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygraph.llm.text import slices

Find = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]


def repeated_anchors(rows: DataFrame, find: Find) -> DataFrame:
    """``_row, _places``: the anchors of each document whose content occurs elsewhere as well.

    ``find`` returns hash, document and place of every anchor of an array of texts. Equal anchors
    of one slice know of each other without a shuffle; they are dealt out by document and only one
    word of them goes to the group of their content. So an anchor that a third of all documents
    share is a few rows per task there. Repeated rows have each place once in their common list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            content, doc, place = find(batch.column("_text"))
            row = batch.column("_row").to_numpy()[doc]
            _, first, inverse, count = np.unique(content, return_index=True, return_inverse=True, return_counts=True)
            known = count[inverse] > 1
            word = first[count > 1]
            group = np.concatenate((np.where(known, row.view(np.uint64), content), content[word]))
            nobody = np.zeros(len(word), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(group.view(np.int64)),
                    pa.array(np.concatenate((row, nobody))),
                    pa.array(np.concatenate((place, nobody - 1)).astype(np.int32)),
                    pa.array(np.concatenate((known, nobody > 0))),
                ],
                names=["_group", "_row", "_place", "_known"],
            )

    found = rows.mapInArrow(run, "_group bigint, _row bigint, _place int, _known boolean")
    count = F.count(F.lit(1)).over(Window.partitionBy("_group", "_known"))
    again = found.withColumn("_count", count).where("_place >= 0 AND (_known OR _count > 1)")
    return again.groupBy("_row").agg(F.collect_set("_place").alias("_places"))
