"""Token ids of a byte-level vocabulary file of the tokenizers library.

The file's vocabulary gives each token's bytes, and its ids are the order of
its merges, so tiktoken's merging loop runs on it as it stands: several times
as fast on words seen for the first time as the library, with the same ids
(tests compare them on random texts and on given documents). A file that is built
another way, and a text that tiktoken gives up, go to the library itself.

Added tokens. As the library does by default, the strings of added tokens
(``<|endoftext|>``) stand for themselves in a text. With ``plain_specials``
they are ordinary text.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Sequence


def shown_bytes() -> dict[int, int]:
    """The byte-level vocabularies' spelling: printable Latin-1 characters
    stand for their own byte, the other bytes for 256, 257, ... in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


def token_bytes(path: str) -> dict[bytes, int]:
    """The bytes of every token but the added ones, and its id."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    byte = {chr(shown): b for b, shown in shown_bytes().items()}
    added = {t["content"] for t in file["added_tokens"]}
    return {bytes([byte[c] for c in token]): i for token, i in file["model"]["vocab"].items() if token not in added}


def _merges_by_id(path: str) -> bool:
    """Whether the file is a plain byte-level one whose merges stand in the
    order of their ids and whose added tokens have no rules of their own."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, pre = file["model"], file["pre_tokenizer"] or {}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    ids = [model["vocab"]["".join(m)] for m in pairs]
    rules = ("single_word", "lstrip", "rstrip", "normalized")
    return (model["type"] == "BPE" and file["normalizer"] is None and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True) and not pre.get("add_prefix_space") and ids == sorted(ids)
            and not any(t.get(r) for t in file["added_tokens"] for r in rules))


class ByteBpe:
    """Encoder for one vocabulary file."""

    def __init__(self, path: str, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = plain_specials
        self._fast = None
        if _merges_by_id(path):
            added = {t.content: i for i, t in self._library.get_added_tokens_decoder().items()}
            tk = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN,
                                   mergeable_ranks=token_bytes(path), special_tokens=added)
            self._fast = tk.encode_ordinary if plain_specials else lambda t: tk.encode(t, allowed_special="all")

    def _ids(self, text: str) -> Sequence[int]:
        if self._fast is not None:
            try:
                return self._fast(text)
            except ValueError:  # its pattern gave up
                pass
        return self._library.encode(text, add_special_tokens=False).ids

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a null
        or empty text has none."""
        return [array("I", self._ids(t)).tobytes() if t else b"" for t in texts]


_encoders: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    """The worker process's encoder, made once."""
    if path not in _encoders:
        _encoders[path] = ByteBpe(path)
    return _encoders[path]
