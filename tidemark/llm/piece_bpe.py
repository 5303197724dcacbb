"""Exact SentencePiece merge-type (BPE) encoding by backtracking, and decoding.

The library merges the best-scored adjacent pair again and again. The result
is the one sequence of pieces in which every two neighbours, merged anew from
their characters, give just these two pieces. So encoding needs no merge
queue: at each position take the longest vocabulary match (all matches of a
word come from one Aho-Corasick pass), go on when it is compatible with the
piece before it, else try its next shorter prefix, and step back when none is
left. A bitfield marks positions from which no way led to the end, so no
position fails twice. Compatibility of a pair is found by merging it again
from characters and kept.

Words. When no piece of the vocabulary holds a word mark after another
character (checked at load), merges never cross the start of a word, and a
word's pieces are kept for the next time it occurs. A character that no piece
holds stands alone and falls back to its bytes.

Decoding joins pieces, turns byte ids into characters (each byte that is no
part of one gives U+FFFD), word marks into spaces, drops control ids, and
drops the one space that encoding put first.

Defined cases: a null or empty text is the end id alone and decodes to "".
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import sub_batches

MARK = "▁"
_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_UNK_TEXT = " ⁇ "
MEMO_WORDS = 300_000


class PieceBpe:
    """Encoder and decoder for one SentencePiece BPE model file."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self._id: dict[str, int] = {}
        self._rank: dict[str, float] = {}
        self._byte_id = {}
        self._text: list[bytes] = []
        self._byte_of: list[int] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            self._byte_of.append(-1)
            if sp.is_byte(i):
                self._byte_of[i] = int(piece[3:-1], 16)
                self._byte_id[self._byte_of[i]] = i
                self._text.append(bytes([self._byte_of[i]]))
            elif sp.is_unknown(i):
                self._text.append(_UNK_TEXT.encode())
            elif sp.is_control(i):
                self._text.append(b"")
            else:
                self._text.append(piece.encode())
                if not sp.is_unused(i):
                    self._id[piece], self._rank[piece] = i, -sp.get_score(i)
        self.unk_id, self.end_id = sp.unk_id(), sp.eos_id()
        # Only an identity normaliser is rebuilt here; another is called for.
        probe = " ééﬁ  　A\n\t "
        self._normalise = None if sp.normalize(probe) == MARK + probe.replace(" ", MARK) else sp.normalize
        self._by_word = not any(MARK in p.lstrip(MARK) for p in self._id)
        chars = {c for p in self._id for c in p}
        self._line_alone = "\n" not in chars
        self._matches = ahocorasick.Automaton()
        for p in self._id:
            self._matches.add_word(p, p)
        self._matches.make_automaton()
        self._prefix: dict[str, str | None] = {}
        self._fits: dict[tuple[str, str], bool] = {}
        self._memo_words, self._memo, self._older = memo_words, {}, {}

    # ------------------------------------------------------------ merging
    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by plain merging: best score first, the
        leftmost of equals."""
        parts, rank = list(text), self._rank
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _compatible(self, left: str, right: str) -> bool:
        fits = self._fits.get((left, right))
        if fits is None:
            if len(self._fits) > 2_000_000:
                self._fits.clear()
            fits = self._fits[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return fits

    def _shorter(self, piece: str) -> str | None:
        """The longest proper prefix that is a piece, or the first character."""
        if piece not in self._prefix:
            n = len(piece) - 1
            while n > 1 and piece[:n] not in self._id:
                n -= 1
            self._prefix[piece] = piece[:n] if n >= 1 else None
        return self._prefix[piece]

    # ------------------------------------------------------------ backtracking
    def pieces(self, text: str) -> list[str]:
        """The pieces of normalised text."""
        n = len(text)
        longest = list(text)
        for end, piece in self._matches.iter(text):
            at = end + 1 - len(piece)
            if len(piece) > len(longest[at]):
                longest[at] = piece
        out: list[str] = []
        live = bytearray(b"\1") * (n + 1)  # place p: no failure known from there
        at, piece = 0, longest[0] if n else None
        while at < n:
            last = out[-1] if out else ""
            while piece is not None:
                end = at + len(piece)
                if live[end] and self._compatible(last, piece):
                    break
                piece = self._shorter(piece)
            if piece is not None:
                out.append(piece)
                at = end
                piece = longest[at] if at < n else None
            else:  # no way on from here: step back to the piece before
                live[at] = 0
                back = out.pop()
                at -= len(back)
                piece = self._shorter(back)
        return out

    def _piece_ids(self, piece: str) -> list[int]:
        i = self._id.get(piece)
        if i is not None:
            return [i]
        if not self._byte_id:
            return [self.unk_id]
        return [self._byte_id[b] for b in piece.encode()]

    def _word(self, word: str) -> list[int]:
        got = self._memo.get(word)
        if got is None:
            got = self._older.get(word)
            if got is None:
                if self._line_alone and "\n" in word and word != "\n":
                    got = [i for p in re.split("(\n)", word) if p for i in self._word(p)]
                else:
                    got = [i for p in self.pieces(word) for i in self._piece_ids(p)]
            if len(self._memo) > self._memo_words:
                self._older, self._memo = self._memo, {}
            self._memo[word] = got
        return got

    def encode(self, text: str | None, end: bool = True) -> list[int]:
        """Ids of a whole text, with the end id last unless ``end`` is false."""
        ids: list[int] = []
        if text:
            if self._normalise:
                text = self._normalise(text)
                words = _WORDS.findall(text) if self._by_word else [text]
            elif self._by_word and "  " not in text and MARK not in text and text[0] != " ":
                words = [MARK + w for w in text.split(" ")]
            else:
                text = MARK + text.replace(" ", MARK)
                words = _WORDS.findall(text) if self._by_word else [text]
            memo = self._memo
            for w in words:
                got = memo.get(w)
                if got is None:
                    got = self._word(w)
                    memo = self._memo
                ids += got
        if end:
            ids.append(self.end_id)
        return ids

    # ------------------------------------------------------------ decoding
    def decode(self, ids: Sequence[int]) -> str:
        raw = b"".join(map(self._text.__getitem__, ids))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._decode_broken(ids)
        first = next((i for i in ids if self._text[i]), None)
        if first is not None and self._byte_of[first] < 0 and text.startswith(MARK):
            text = text[1:]
        return text.replace(MARK, " ")

    def _decode_broken(self, ids: Sequence[int]) -> str:
        """Byte ids that form no character give U+FFFD each."""
        out, run = [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[at:at + n].decode())
                        at += n
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            run.clear()

        for i in ids:
            if self._byte_of[i] >= 0:
                run.append(self._byte_of[i])
            else:
                flush()
                out.append(self._text[i].decode())
        flush()
        return "".join(out)


_coders: dict[str, PieceBpe] = {}


def coder(path: str) -> PieceBpe:
    """The worker process's coder: words stay known from task to task."""
    if path not in _coders:
        _coders[path] = PieceBpe(path)
    return _coders[path]


def encode_table(docs: DataFrame, model_path: str, digest: bool = False) -> DataFrame:
    """doc_id, n_tokens and, for each whole text, its ``ids`` and the
    ``decoded`` text, or with ``digest`` their SHA-256. One narrow pass."""
    kinds = ("ids_sha256 string, decoded_sha256 string" if digest
             else "ids array<int>, decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(model_path)
        show = [str(i).encode() for i in range(len(c._text))]
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in sub_batches(batches):
            ids = [c.encode(t) for t in b.column(1).to_pylist()]
            back = [c.decode(x) for x in ids]
            if digest:
                last = [pa.array([sha(b" ".join(map(show.__getitem__, x))) for x in ids]),
                        pa.array([sha(t.encode()) for t in back])]
            else:
                last = [pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in ids], pa.int64()), *last],
                names=["doc_id", "n_tokens", *(k.split()[0] for k in kinds.split(", "))])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, n_tokens long, {kinds}")
