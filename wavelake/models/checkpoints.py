"""Configurations and weights of injected models: a folder with config.json and weights.npz."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from pathlib import Path
from typing import Any

import numpy as np


def config(folder: str, overrides: Mapping[str, Any] | None = None, fetch: Callable[[str], str] | None = None) -> dict[str, Any]:
    """The folder's configuration, with the overrides whose keys it has. A name that is no folder is fetched, if there is a way to."""
    at = Path(folder)
    if not at.is_dir():
        if fetch is None:
            raise FileNotFoundError(f"no folder {folder}")
        at = Path(fetch(folder))
    found = json.loads((at / "config.json").read_text())
    return found | {k: v for k, v in (overrides or {}).items() if k in found}


def weights(folder: str, wanted: set[str], may_lack: str = r"(?!)", strict: bool = True) -> dict[str, np.ndarray]:
    """The wanted arrays of a folder. If strict, others in the file are an error, and so are missing ones unless ``may_lack`` matches them."""
    with np.load(Path(folder) / "weights.npz") as found:
        missing = sorted(k for k in wanted - set(found.files) if not re.search(may_lack, k))
        unexpected = sorted(set(found.files) - wanted)
        if strict and (missing or unexpected):
            raise KeyError(f"missing {missing}, unexpected {unexpected}")
        return {k: found[k] for k in found.files if k in wanted}
