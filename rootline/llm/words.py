"""Words of a batch of texts as numbers, vectorised: each distinct word is looked at once."""

from __future__ import annotations

import ctypes
import gc
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

try:
    _TRIM = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library
    _TRIM = None


class Words:
    """The white-space separated words of some texts: code (place in ``vocabulary``) and doc of each, in order."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lists = pc.ascii_split_whitespace(texts)
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.list_flatten(lists)
        doc = np.repeat(np.arange(len(texts)), n)
        real = pc.not_equal(flat, "")
        if len(flat) and not pc.all(real).as_py():
            keep = real.to_numpy(zero_copy_only=False)
            flat, doc = flat.filter(real), doc[keep]
        coded = flat.dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        self.docs = len(texts)
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(coded) else np.zeros(0, np.int64)
        self.vocabulary: list[str] = coded.dictionary.to_pylist()
        self.doc = doc
        self.count = np.bincount(doc, minlength=len(texts))

    def per_doc(self, weights: np.ndarray) -> np.ndarray:
        """The sum of a number for each word over each document's words."""
        return np.bincount(self.doc, weights, self.docs)


def tidy() -> None:
    """Gives freed memory back to the system: a Python worker serves many tasks, and what it holds counts at the executor."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def tidied(run):
    """A function for mapInArrow that tidies up after each batch and at its end."""

    @wraps(run)
    def out(batches):
        for batch in run(batches):
            yield batch
            del batch
            tidy()
        tidy()

    return out


def tidied_after(run):
    """A function that tidies up when it has returned: for those that hold a sample on the driver, whose Python otherwise keeps
    the room of the sample for as long as the session lives."""

    @wraps(run)
    def out(*args, **kwargs):
        try:
            return run(*args, **kwargs)
        finally:
            gc.collect()
            tidy()

    return out


def bounded(batches, most_bytes: int = 1_000_000):
    """Batches cut so that a part's texts (second column) have about so many bytes at most; a longer text stands alone."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total, at = np.cumsum(size), 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most_bytes, "right")))
            yield batch.slice(at, end - at)
            at = end
