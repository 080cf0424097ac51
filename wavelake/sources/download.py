"""Files fetched once: downloads and archives appear under their name only when they are whole."""

from __future__ import annotations

import os
import shutil
import uuid
import zipfile
from pathlib import Path
from urllib.request import urlopen


def fetched(url: str, path: str) -> str:
    """The local file, downloaded if it is not there."""
    if not os.path.exists(path):
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}.part"
        try:
            with urlopen(url) as source, open(part, "wb") as out:  # noqa: S310  the caller names the address
                shutil.copyfileobj(source, out)
            os.replace(part, path)
        finally:
            Path(part).unlink(missing_ok=True)
    return path


def unzipped(archive: str, folder: str) -> str:
    """The folder, unpacked if it is not there; of several that unpack at once the first wins."""
    if not os.path.isdir(folder):
        part = f"{folder}.{uuid.uuid4().hex}.part"
        try:
            with zipfile.ZipFile(archive) as z:
                z.extractall(part)
            try:
                os.rename(part, folder)
            except OSError:
                if not os.path.isdir(folder):
                    raise
        finally:
            shutil.rmtree(part, ignore_errors=True)
    return folder
