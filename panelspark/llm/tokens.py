"""Token ids by the ``tokenizers`` library inside tasks, as little-endian unsigned 32-bit bytes.

A text is encoded piece by piece, cut at ASCII white space, and pieces that were seen before are looked up. That
gives the ids of the whole text for a tokenizer whose pre-tokenizer drops white space and never looks across it, which
makes one word of a run of letters, and whose byte-level model works on lower case.
"""

from __future__ import annotations

import os
import string

import numpy as np

from panelspark.llm.bpe import byte_symbols
from panelspark.llm.worker import kept

PUNCTUATION = string.punctuation.encode()
PIECES_KEPT = 400_000
PLAIN_BELOW = "\u0250"  # Latin letters: composed, and lower-cased one by one


class PieceIds(dict):
    """Ids of pieces, filled on demand.

    When ``PIECES_KEPT`` of them are held they become the older half and a new half begins; what is asked for again
    moves over, so that frequent pieces stay and memory is bounded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.symbols = dict(enumerate(byte_symbols()))
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.ids_of(piece)
        if len(self) >= PIECES_KEPT:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def ids_of(self, piece: bytes) -> bytes:
        word = piece.rstrip(PUNCTUATION)
        last = word[-4:].decode("utf-8", "ignore")[-1:]
        if word != piece and last.isalpha() and b"<|" not in piece:  # marks after a letter are words of their own
            return self[word] + self[piece[len(word):]]
        text = piece.decode("utf-8", "replace")
        if text.isalpha() and max(text) < PLAIN_BELOW:  # one word for the pre-tokenizer: the model alone has to look at it
            lower = text.lower()
            if lower != text and lower.isalpha():
                return self[lower.encode()]
            if lower == text:
                found = self.model.tokenize(piece.decode("latin-1").translate(self.symbols))
                return np.array([t.id for t in found], "<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: bytes | None) -> bytes:
        return b"".join(map(self.__getitem__, text.split())) if text else b""


def piece_ids(path: str) -> PieceIds:
    """One per tokenizer file and Python worker."""
    return kept(("piece_ids", path), lambda: PieceIds(path))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
