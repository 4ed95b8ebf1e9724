"""Where the vocabulary files of public tokenizers are: a folder that is the same on the driver and all executors."""

from __future__ import annotations

import os

FOLDER = "LUMETRA_TOKENIZERS"


def vocabulary(name: str) -> str:
    """The path of a file in the folder that the environment names, else in that of the installed package."""
    if folder := os.environ.get(FOLDER):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
