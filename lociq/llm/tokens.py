"""Token ids of whole texts by a public tokenizer, with a bounded per-process cache of words.

Both tokenizers split a text into words first and never merge across these, so ids of a text are those of its chunks in
order: a word with the one space before it, what stands between it and the next white space, or white space. Chunks repeat a lot; each is
encoded once by the tokenizers library and then looked up. Tests hold this against encoding whole texts.
"""

from __future__ import annotations

import functools
import os
import re
from array import array

import numpy as np

END = 2
CACHE = 300_000  # chunks kept in a worker
# fixed values: the Unicode White_Space characters
SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# a run of these letters ends where an ASCII character that is no letter follows; both tokenizers part there
LETTERS = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff"
WORD = f"[{LETTERS}]+(?=[\\x00-\\x40\\x5b-\\x60\\x7b-\\x7f]|$)"


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or for other bytes the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return {b: chr(b if b in plain else next(other)) for b in range(256)}


class Encoder(dict):
    """ids(text) of one tokenizer file; as a dictionary, the ids of the chunks met so far (unsigned 16-bit, as bytes).

    Strings of special tokens in a text get these tokens' ids, as the library has it by default, or are ordinary text if ``plain``.
    """

    def __init__(self, file: str, plain: bool = False):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = plain
        added = [] if plain else [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(added)).search if added else None
        self.model = self.tokenizer.model
        self.keeps_space = "ByteLevel" in repr(type(self.tokenizer.pre_tokenizer))
        word = f" ?{WORD}" if self.keeps_space else WORD
        self.chunks = re.compile(f"{word}| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+" if self.keeps_space else f"{word}|[^{SPACE}]+").findall
        self.is_word = re.compile(word).fullmatch
        self.characters = byte_characters()

    def __missing__(self, chunk: str) -> bytes:
        if self.is_word(chunk):
            # a single word of these letters needs no normalizing but lower case, and no parting: its bytes go to the merges
            plain = chunk if self.keeps_space else chunk.lower()
            ids = [t.id for t in self.model.tokenize(plain.encode().decode("latin-1").translate(self.characters))]
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        found = array("H", ids).tobytes()
        if len(self) < CACHE:
            self[chunk] = found
        return found

    def ids(self, text: str) -> np.ndarray:
        """Ids of the whole text, without the end id. A text that holds a special token's string goes to the library whole."""
        if self.special and self.special(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint16)
        return np.frombuffer(b"".join(map(self.__getitem__, self.chunks(text))), np.uint16)


@functools.cache
def encoder(file: str, plain: bool = False) -> Encoder:
    return Encoder(file, plain)


def with_end(ids: np.ndarray) -> np.ndarray:
    """Little-endian unsigned 32-bit ids of a document, end id included."""
    out = np.empty(len(ids) + 1, "<u4")
    out[:-1], out[-1] = ids, END
    return out


def small(batches, rows: int = 256):
    """The same rows in batches of at most ``rows``, so that few texts and their ids are held at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
