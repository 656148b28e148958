"""Anchors: content-chosen suffixes, one at least in every window of a text.

A window of *length* bytes is anchored at the leftmost of its *gram*-byte
substrings with the least hash. Equal windows are anchored at the same offset,
so two places can share a window only if they share its anchor. Consecutive
windows mostly share their anchor, so a text has about ``2 / (length - gram)``
anchors per byte, each standing for a run of windows.
"""

from __future__ import annotations

import numpy as np

from .blocks import Block, mix, undo_powers

_NEVER = np.uint32((1 << 32) - 1)


def anchors(block: Block, length: int, gram: int):
    """(anchor, hash, first, count) arrays: windows ``first .. first+count-1``
    (byte offsets in the block) are anchored at ``anchor``."""
    size = len(block.data)
    if size < length:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), none, none
    prefix = block.prefix(False)
    full = mix((prefix[gram:] - prefix[:-gram]) * undo_powers(size - gram + 1))
    value = (full >> np.uint64(32)).astype(np.uint32)
    place = np.arange(size, dtype=np.int32)
    room = np.repeat(block.doc_end.astype(np.int32), block.doc_end - block.doc_start + 1)[:size] - place  # bytes left in the text
    value[room[:len(value)] < gram] = _NEVER
    least, at = value, place[:len(value)]
    width, span = 1, length - gram + 1
    while width < span:  # double the windows; the left one wins a tie
        step = min(width, span - width)
        take = least[step:] < least[:-step]
        least = np.where(take, least[step:], least[:-step])
        at = np.where(take, at[step:], at[:-step])
        width += step
    at = at[room[:len(at)] >= length]
    window = np.flatnonzero(room[:size - length + 1] >= length)
    if not len(window):
        return anchors(Block([]), length, gram)
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1])))
    count = np.diff(np.append(first, len(at)))
    anchor = at[first].astype(np.int64)
    return anchor, full[anchor], window[first], count
