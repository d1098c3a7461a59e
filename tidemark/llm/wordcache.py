"""Encode texts chunk by chunk: equal chunks are encoded once per task and looked up after."""

from __future__ import annotations

from collections.abc import Callable


class ChunkCache:
    """Encoded bytes of chunks; ``encode(list of chunks)`` gives the bytes of new ones. Starts
    afresh beyond ``limit`` chunks, so its memory stays bounded whatever the vocabulary."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = 300_000):
        self.encode, self.limit, self.known = encode, limit, {}

    def all(self, texts: list[list[str]]) -> list[bytes]:
        """The joined bytes of each list of chunks."""
        wanted = set().union(*texts) if texts else set()
        if len(self.known) > self.limit:
            self.known = {}
        new = [c for c in wanted if c not in self.known]
        if new:
            self.known.update(zip(new, self.encode(new)))
        get = self.known.__getitem__
        return [b"".join(map(get, chunks)) for chunks in texts]
