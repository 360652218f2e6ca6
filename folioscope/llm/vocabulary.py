"""Rank files of byte-level vocabularies: a token in base 64 and its rank on each line."""

from __future__ import annotations

import base64


def load_ranks(path: str) -> dict[bytes, int]:
    """Read on the driver; a vocabulary has a fixed size of a few megabytes at most."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
