"""The prompts of the package, texts in its folder `prompts`."""

from __future__ import annotations

import re
from functools import lru_cache
from importlib import resources


@lru_cache(maxsize=64)
def prompt(name: str) -> str:
    """A prompt by folder and file."""
    if not re.fullmatch(r"[\w-]+(?:/[\w-]+)*\.txt", name):
        raise ValueError(name)
    return (resources.files("litweave") / "prompts" / name).read_text(encoding="utf-8")
