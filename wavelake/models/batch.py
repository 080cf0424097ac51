"""Requests of one batch as arrays for a model: padded samples, frame masks, anchors."""

from __future__ import annotations

import numpy as np
import pandas as pd

from ..operators.alignment import TOKENS
from ..sources import audio


def collated(rows: pd.DataFrame, hop: int = 1920, rate: int = 48000) -> dict[str, object]:
    """From rows of signal, description and anchors (null, or spans of token, start_s, end_s): samples up to whole frames of the longest, sizes
    in frames, the mask of frames, token ids of each request's slots, and the slot of each frame.

    Slot 0 is for no anchor and slot 1 for padding; anchors follow in order, and a later one hides an earlier one.
    """
    signals = [np.asarray(x, float) for x in rows.signal]
    samples, mask = audio.padded_batch(signals, hop)
    alignment = np.where(mask, 0, 1)
    ids = []
    for k, anchors in enumerate(rows.anchors if "anchors" in rows else [None] * len(rows)):
        own = [TOKENS["<null>"], TOKENS["<pad>"]]
        for anchor in anchors if anchors is not None else []:
            first, end = (int(np.ceil(anchor[t] * rate / hop)) for t in ("start_s", "end_s"))
            alignment[k, first:end] = len(own)
            own.append(TOKENS[anchor["token"]])
        ids.append(own)
    most = max(map(len, ids), default=0)
    padded = np.array([x + [TOKENS["<pad>"]] * (most - len(x)) for x in ids], int).reshape(len(ids), most)
    return {"samples": samples, "sizes": mask.sum(1), "mask": mask, "descriptions": rows.description.tolist(), "anchor_ids": padded, "alignment": alignment}
