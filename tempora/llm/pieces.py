"""SentencePiece encoding and decoding: one forward pass over the trie of a batch's distinct marked words."""

from __future__ import annotations

import functools
import itertools
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import in_small_batches
from tempora.llm.wordcache import WordCache

MARK = "▁"
#: Pairs of pieces that a worker keeps, and characters of the texts whose new words make one trie.
PAIR_ROWS, TRIE_CHARS = 1 << 18, 1 << 20
UNKNOWN = -1


class PieceModel:
    """A byte-pair model with byte fallback whose pieces never reach from a word into the next mark."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.id = {model.id_to_piece(i): i for i in plain}
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self._take_apart()
        ending = ahocorasick.Automaton()
        for piece, i in self.id.items():
            ending.add_word(piece, (i, len(piece)))
        ending.make_automaton()
        #: All pieces that end at each place of a word, the longest first.
        self.ending = ending.iter
        self.bytes = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
        if len(self.bytes) != 256 or any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError(f"{path}: needs byte fallback and pieces that hold marks at their beginning only")
        self.piece = [model.id_to_piece(i) for i in ids]
        self.raw = [b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else bytes([int(self.piece[i][1:-1], 16)]) if model.is_byte(i) else self.piece[i].replace(MARK, " ").encode() for i in ids]
        self.control = np.array([model.is_control(i) for i in ids])
        self.pairs: dict[int, bool] = {}

    def merge(self, text: str, until: int = 1) -> list[str]:
        """Pieces of a short text by the model's definition: again and again merge the best pair, the leftmost first."""
        parts = list(text)
        while len(parts) > until:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _take_apart(self) -> None:
        """Rank of each piece's last merge (-1 for single characters) and the two parts that it joined."""
        self.rank = {p: r for r, p in enumerate(sorted(self.score, key=self.score.get, reverse=True))}
        self.made, self.parts = {}, {}
        for piece in list(self.id):
            if len(piece) == 1:
                self.made[piece] = -1
                continue
            parts = self.merge(piece, until=2)
            if len(parts) == 2:
                self.made[piece], self.parts[piece] = self.rank[piece], parts
            else:
                del self.id[piece]  # its characters never merge to it

    def adjoin(self, left: int, right: int) -> bool:
        """Whether merging the text of two pieces gives just them.

        The merges are gone through backwards. Before the later one of both pieces' last merges, its parts stood there;
        had what then touched at the border merged earlier, the pieces would never have come about.
        """
        key = left << 32 | right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= PAIR_ROWS:
                self.pairs.clear()
            found = self.pairs[key] = self._stay_apart(self.piece[left], self.piece[right])
        return found

    def _stay_apart(self, a: str, b: str) -> bool:
        rank, made, parts, bound = self.rank, self.made, self.parts, float("inf")
        while True:
            if rank.get(a + b, bound) < bound:
                return False
            of_a, of_b = made[a], made[b]
            if of_a < 0 and of_b < 0:
                return True
            if of_a > of_b:
                a, bound = parts[a][1], of_a
                if a not in made:
                    made[a] = -1  # a character that is no piece itself
            else:
                # At equal ranks the left pair goes first, and the border lies left of this merge.
                b, bound = parts[b][0], of_b + 0.5
                if b not in made:
                    made[b] = -1

    def encode_sorted(self, words: list[str]) -> Iterator[list[int]]:
        """Ids of each of the sorted ``words``, walking their trie depth-first.

        Forward state of a prefix: its last piece and where that begins. A byte-pair model has exactly one last piece
        for every prefix: the one that can stand behind the state of the prefix before it. What two neighbours share
        as a prefix is the path of the trie to their fork, whose states stay and are used again.
        """
        ending, pairs, adjoin = self.ending, self.pairs, self.adjoin
        last, start, before = [UNKNOWN], [0], ""
        for word in words:
            n = len(word)
            depth, most = 0, min(n, len(before))
            while depth < most and word[depth] == before[depth]:
                depth += 1
            del last[depth + 1 :], start[depth + 1 :]
            undecided = depth  # the first place whose prefix has no state
            for at, (piece, size) in ending(word):
                if at < undecided:
                    continue
                while undecided < at:  # a character that no piece ends with
                    last.append(UNKNOWN)
                    start.append(undecided)
                    undecided += 1
                begin = at + 1 - size
                left = last[begin]
                if left >= 0:
                    found = pairs.get(left << 32 | piece)
                    if not (found or found is None and adjoin(left, piece)):
                        continue
                last.append(piece)
                start.append(begin)
                undecided += 1
            for at in range(undecided, n):
                last.append(UNKNOWN)
                start.append(at)
            out, end = [], n
            while end:
                if last[end] < 0:
                    out.extend(self.bytes[b] for b in reversed(word[end - 1].encode("utf-8", "surrogatepass")))
                else:
                    out.append(last[end])
                end = start[end]
            out.reverse()
            before = word
            yield out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: marks are spaces, the first one is no part of it; broken byte runs become U+FFFD."""
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@functools.lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


@functools.lru_cache(maxsize=2)
def word_cache(path: str) -> WordCache:
    """The worker's own, kept from task to task."""
    return WordCache(load(path).encode_sorted)


_word = re.compile(f"{MARK}+[^{MARK}]*").findall


def marked_words(text: str | None) -> list[str]:
    """The runs of a marked text that no piece crosses: a mark is put before the text and for every space."""
    return _word(MARK + text.replace(" ", MARK)) if text else []


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_crc32, ids) for every row: the piece ids of the whole text, without begin or end, as the library gives them.

    Null and empty texts have no ids. Repeated rows are kept, an empty table gives an empty result, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(model_path)
        for batch in batches:
            texts, at = batch.column(2), 0
            while at < batch.num_rows:
                first, some, chars = at, [], 0
                while at < batch.num_rows and chars < TRIE_CHARS:
                    text = texts[at].as_py()
                    some.append(marked_words(text))
                    chars += len(text or "")
                    at += 1
                ids, starts = cache.encode_lists(some)
                lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:at], batch.column(1)[first:at], lists], ["doc_id", "text_crc32", "ids"])

    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), text.alias("text"))
    return in_small_batches(rows).mapInArrow(run, "doc_id long, text_crc32 long, ids array<int>")


def decode_pieces(coded: DataFrame, model_path: str) -> DataFrame:
    """``coded`` (doc_id, text_crc32, ids) with the decoded text behind its columns; no ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            lists = batch.column(2)
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_pylist()
            texts = [model.decode(flat[a:b]) for a, b in itertools.pairwise(offsets)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "text_crc32", "ids", "decoded"])

    return coded.select("doc_id", "text_crc32", "ids").mapInArrow(run, "doc_id long, text_crc32 long, ids array<int>, decoded string")


def piece_digest(coded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, round_trip) of encoded documents: each is decoded again and compared by CRC-32 with its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            lists = batch.column(2)
            flat, offsets = lists.values.to_numpy().astype("<u4"), lists.offsets.to_pylist()
            spans = [flat[a:b] for a, b in itertools.pairwise(offsets)]
            crc = [zlib.crc32(s.tobytes()) for s in spans]
            same = [zlib.crc32(model.decode(s).encode()) == want for s, want in zip(spans, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in spans], pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], ["doc_id", "n_pieces", "ids_crc32", "round_trip"])

    return coded.select("doc_id", "text_crc32", "ids").mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean")
