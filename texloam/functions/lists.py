"""Arrow list columns, changed buffer by buffer, for use inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def with_values(lists: pa.Array, values: pa.Array) -> pa.Array:
    """Lists as long as the given ones, of other values; null lists stay null."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=lists.is_null())


def replace_words(lists: pa.Array, words: pa.Array, others: pa.Array) -> pa.Array:
    """Lists of strings, each of ``words`` replaced by its partner in ``others``.

    Strings are numbered first and looked up once each, so a batch is never a
    Python object for every string.
    """
    flat = lists.flatten()
    numbered = flat.dictionary_encode()
    known = numbered.dictionary
    new = pc.coalesce(others.take(pc.index_in(known, value_set=words)), known)
    return with_values(lists, new.take(numbered.indices))
