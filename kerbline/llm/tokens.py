"""Encoding of whole texts with a tokenizer file, inside Spark tasks.

The byte-level pre-tokenizer never joins what stands before and after a blank between two words, nor letters or
digits with the marks after them, so a text is cut there and each distinct cut is encoded once and remembered;
the tokenizer itself decides everything inside a cut (an apostrophe and the letters after it stay in one).  A text
that holds one of the tokenizer's own added tokens (such as an end-of-text mark), or one of the control characters 28
to 31, which the cutting pattern and the tokenizer see differently, is encoded as it is.  Both ways give the same ids
as encoding the text in one call.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import public_tokenizers

TOKENIZER = "byte_bpe_50k.json"
#: Distinct cuts that a worker remembers; beyond it starts afresh.
REMEMBERED = 1_000_000
#: Cuts that are encoded in one call.
AT_ONCE = 20_000
_CUTS = re.compile(r" ?[^\W_]+| ?(?:[^\w\s']|_)*'(?:[^\w\s]|_)*[^\W_]*| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s")
_ODD = "[\x1c-\x1f]"


def _signs_of_bytes() -> dict[int, str]:
    """How byte-level tokenizers write bytes: printable ones of Latin-1 as themselves, the others from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b != 173]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


def default_path() -> str:
    return public_tokenizers.path(TOKENIZER)


class Encoder:
    """Encodes texts to arrays of little-endian ids, 16 bits wide where the vocabulary allows, else 32."""

    _of_path: dict[str, Encoder] = {}
    _line_end = re.compile("[\n\r]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.whole = re.compile("|".join([_ODD, *(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())]))
        self.line_feed = self._ids(["\n"])[0][0]
        self.bare, self.signs = self._model_alone(), _signs_of_bytes()

    @classmethod
    def get(cls, path: str) -> Encoder:
        """One per worker process, so that what is remembered serves all its tasks."""
        if path not in cls._of_path:
            cls._of_path[path] = cls(path)
        return cls._of_path[path]

    def _model_alone(self):
        """The tokenizer's model without its cutting, for cuts of letters alone: those it would leave whole."""
        from tokenizers import Tokenizer, pre_tokenizers

        if self.tokenizer.normalizer is not None or "ByteLevel(add_prefix_space=False" not in str(self.tokenizer.pre_tokenizer):
            return None
        bare = Tokenizer(self.tokenizer.model)
        bare.pre_tokenizer = pre_tokenizers.Split(_signs_of_bytes()[10], "isolated")
        return bare

    def _learn_letters(self, cuts: list[str]) -> None:
        for at in range(0, len(cuts), AT_ONCE):
            part = cuts[at : at + AT_ONCE]
            written = "\n".join(part).encode().decode("latin-1").translate(self.signs)
            self._remember(part, np.array(self.bare.encode_batch_fast([written], add_special_tokens=False)[0].ids, self.dtype))

    def _remember(self, cuts: list[str], ids: np.ndarray) -> None:
        """ids: of the cuts one to a line."""
        ends = np.flatnonzero(ids == self.line_feed)
        if len(ends) != len(cuts) - 1:
            raise ValueError("this tokenizer joins lines")
        for cut, a, b in zip(cuts, np.concatenate([[0], ends + 1]).tolist(), np.concatenate([ends, [len(ids)]]).tolist()):
            self.known[cut] = ids[a:b].tobytes()

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, cuts: list[str]) -> None:
        """Encodes cuts many at a time, one to a line: a line feed between two words is a token of its own."""
        if self.bare is not None:
            letters = [c for c in cuts if c.isalpha() or c[:1] == " " and c[1:].isalpha()]
            self._learn_letters(letters)
            cuts = list(set(cuts).difference(letters))
        plain = [c for c in cuts if c.strip() and not self._line_end.search(c)]
        for at in range(0, len(plain), AT_ONCE):
            part = plain[at : at + AT_ONCE]
            self._remember(part, self._ids(["\n".join(part)])[0])
        odd = list(set(cuts).difference(plain))
        self.known.update(zip(odd, (x.tobytes() for x in self._ids(odd))))

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text as bytes; null is empty."""
        texts = [t or "" for t in texts]
        cuts = [None if self.whole.search(t) else _CUTS.findall(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set().union(*filter(None, cuts)).difference(self.known))
        if new:
            self._learn(new)
        known = self.known.__getitem__
        return [self._ids([t])[0].tobytes() if cs is None else b"".join(map(known, cs)) for t, cs in zip(texts, cuts)]


def slices(batch, size: int = 256):
    """An Arrow batch in pieces of at most ``size`` rows."""
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)
