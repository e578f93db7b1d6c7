"""64-bit hashes of numbers and words in columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ALL = (1 << 64) - 1
GROUP_BYTES = 500_000


def mixed(keys: np.ndarray, seed: int = 0) -> np.ndarray:
    """64 well-mixed bits of each number; different numbers stay different."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & ALL)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def groups(texts: pa.Array, most: int = GROUP_BYTES) -> Iterator[pa.Array]:
    """Runs of texts of about ``most`` bytes, one text at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes.astype(np.int64)), 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield texts.slice(at, end - at)
        at = end


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, A-Z in lower case, and where each text's words begin and end."""
    from xxhash import xxh3_64_intdigest

    clean = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    split = pc.ascii_split_whitespace(clean)
    words = split.flatten().dictionary_encode()
    distinct = words.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.fromiter(map(xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    at = words.indices.to_numpy()
    edges = split.offsets.to_numpy().astype(np.int64)
    if b"" in distinct:  # texts without a word have one that is empty
        full = at != distinct.index(b"")
        edges = np.concatenate([[0], np.cumsum(full)])[edges]
        at = at[full]
    return hashes[at], edges
