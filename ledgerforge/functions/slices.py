"""Batches in slices, so that what a Python function makes of a batch is never in memory at once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd


def sliced(batches: Iterator[pd.Series], most: int = 1 << 19) -> Iterator[pd.Series]:
    """Batches of texts cut so that a slice's texts have at most so many characters together, or it is one text."""
    for batch in batches:
        start, held = 0, 0
        for at, text in enumerate(batch):
            held += len(text) if text else 1
            if held > most and at > start:
                yield batch.iloc[start:at]
                start, held = at, len(text) if text else 1
        yield batch.iloc[start:]
