"""Words of text batches as codes: what a word-level BPE gives for a text is the sequence of what it gives for its words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def coded_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The codes of all words, the distinct words by code, and where each text's codes begin.

    Words are split at space and 0x09-0x0D, which no token crosses; an empty piece before the first word has a code too.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    coded = lists.flatten().dictionary_encode()
    first = lists.offsets.to_numpy(zero_copy_only=False)
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, first - first[0]


def ragged(values: np.ndarray, first: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated lists of ``codes``, list ``c`` being ``values[first[c]:first[c + 1]]``, and where each begins."""
    sizes = np.diff(first)[codes]
    begins = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(first[codes] - begins[:-1], sizes) + np.arange(begins[-1])
    return values[at], begins
