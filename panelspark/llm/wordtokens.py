"""Token ids of whole texts by the tokenizers library, each distinct white-space-free chunk encoded once a worker.

The word tokenizer drops white space and never merges across it, so a text's ids are those of its chunks one after
the other; ``bytes.split`` cuts at ASCII white space, and the library sees every chunk as it is.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHED = 600_000  # chunks that a worker keeps, about 170 bytes each
LONGEST = 64  # bytes of a chunk that is kept
MARKS = b".,;:!?#$%&*)"
SLICE = 1 << 20  # bytes of text encoded at a time
BORDER = "<|startoftext|>"  # special token put between chunks, so that the library gets many at a time
TOGETHER = 200


class ChunkEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        # For words of a-z alone normalizing, splitting and the byte alphabet change nothing.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.border = self.library.token_to_id(BORDER)
        self.kept: dict[bytes, bytes] = {}

    def _ids(self, chunks: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Every chunk with its ids. Chunks that might hold a special token are encoded one by one."""
        alone = [c for c in chunks if b"<|" in c]
        for c, e in zip(alone, self.library.encode_batch_fast([c.decode() for c in alone], add_special_tokens=False)):
            yield c, array("I", e.ids).tobytes()
        plain = [c for c in chunks if c.isalpha() and c.islower()]
        others = set(chunks).difference(alone, plain)
        between = f" {BORDER} ".encode()
        for library, part in ((self.plain, plain), (self.library, list(others))):
            groups = [part[i:i + TOGETHER] for i in range(0, len(part), TOGETHER)]
            found = library.encode_batch_fast([between.join(g).decode() for g in groups], add_special_tokens=False)
            for group, e in zip(groups, found):
                ids = array("I", e.ids)
                flat, begun = ids.tobytes(), 0
                ends = np.append(np.flatnonzero(np.frombuffer(ids, np.uint32) == self.border), len(ids)).tolist()
                for c, end in zip(group, ends):
                    yield c, flat[4 * begun:4 * end]
                    begun = end + 1

    @staticmethod
    def _chunks(text: bytes) -> list[bytes]:
        # The tokenizer lower-cases all but its special tokens, which start with "<|"; doing A-Z here makes chunks alike. It composes
        # marks before that, and some letters compose with a mark in lower case only: chunks with marks U+0300 to U+037F,
        # which begin with bytes CC and CD, stay as they are.
        if b"<|" in text:
            return text.split()
        if b"\xcc" in text or b"\xcd" in text:
            return [c if b"\xcc" in c or b"\xcd" in c else c.lower() for c in text.split()]
        return text.lower().split()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        if len(self.kept) > CACHED:
            self.kept.clear()
        kept, split = self.kept, [self._chunks(t) for t in texts]
        new = set().union(*split).difference(kept)
        # A run of marks behind a letter or digit is a token sequence of its own, so a word is encoded once for all its marks.
        parts = {}
        for c in new:
            core = c.rstrip(MARKS)
            if len(core) < len(c) and core[-1:].isalnum():
                parts[c] = core, c[len(core):]
        lone = list(new.difference(parts).union(*parts.values()).difference(kept))
        kept.update(self._ids(lone))
        for c, (core, marks) in parts.items():
            kept[c] = kept[core] + kept[marks]
        look_up = kept.__getitem__
        out = [b"".join(map(look_up, s)) for s in split]
        for c in new.union(lone):
            if len(c) > LONGEST:
                del kept[c]
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def slices(texts: list[bytes], most: int = SLICE) -> Iterator[list[bytes]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode_texts(texts: list[bytes], path: str) -> Iterator[bytes]:
    for part in slices(texts):
        yield from encoder(path).encode(part)


def id_lists(parts: list[bytes]) -> pa.ListArray:
    """An Arrow list of int32 from ids in bytes."""
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)]).astype(np.int32)
    flat = np.frombuffer(b"".join(parts), np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def id_bytes(lists: pa.ListArray) -> list[bytes]:
    """Back from an Arrow list to one bytes a row."""
    ends = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.int32, copy=False).tobytes()
    return [flat[4 * a:4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
