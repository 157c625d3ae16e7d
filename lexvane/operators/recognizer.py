"""Hook for a user's own entity recognizer."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column
from pyspark.sql.types import IntegerType

Recognizer = Callable[[str], Iterable[str]]


def recognizer_flag(
    text: Column, load: Callable[[], Recognizer], types: tuple[str, ...], batch_size: int = 256
) -> Column:
    """1 where the recognizer finds an entity of a wanted type, else 0.

    ``load`` builds the recognizer once per worker process, which keeps it for
    its later tasks; texts arrive in Arrow batches of up to ``batch_size``. A
    null or empty text, or one the recognizer fails on, counts as 0; the other
    texts of its batch keep their answers.
    """
    wanted = frozenset(types)

    def make_predict() -> Callable[[np.ndarray], np.ndarray]:
        recognize = load()

        def one(value: object) -> int:
            if not isinstance(value, str) or not value:
                return 0
            try:
                return int(not wanted.isdisjoint(recognize(value)))
            except Exception:
                return 0

        return lambda texts: np.array([one(value) for value in texts], np.int32)

    return predict_batch_udf(make_predict, return_type=IntegerType(), batch_size=batch_size)(text)
