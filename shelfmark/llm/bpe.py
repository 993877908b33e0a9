"""Byte-level BPE: encoding by backtracking over the longest matches, and decoding.

A token sequence is the one that the merges give exactly if each two neighbours are what the merges give for their own
bytes: merges within two tokens go on undisturbed until the first that crosses a border, and that one would have crossed
it without the rest as well. So a piece is encoded from left to right: take the longest token that starts here and that
is compatible with the token before; where none is, give the place up for good, go back one token and take its
next shorter prefix. Prefixes have one encoding, so every place is reached once at most and the work is linear in the piece.

Two tokens are compatible if no merge crosses their border. What meets at the border are the parts along the right edge of
the first and the left edge of the second token; a part lives until the merge that takes it up. A crossing merge happens
if it comes before both parts end (at equal rank the left one of two merges comes first). The answer is memoised.

Longest matches come from a pyahocorasick trie of the tokens' bytes, mapped one to one to Latin-1 characters. Ranks must rise
along merges, as in vocabularies that were trained; a token that merges can't reach is taken only where it is a whole piece.

The vocabulary is read on the driver from a path that is a parameter, is a few MB at most by its number of tokens, and is
broadcast; the trie is built once in each worker. Texts stay where they are: nothing is shuffled.

Nulls and edges: a null or empty text has no tokens; a null array of ids decodes to null; repeated rows are encoded
each by itself; an empty table gives an empty result; a text is cut where a space follows other characters, which is
always a border of pieces, so that of a very long one only its ids are held besides a stretch; ids that the vocabulary
lacks raise an error; other columns stay, but those named like the new one, which it replaces. There are no ties.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm._session import table

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Characters of a text that are cut into pieces at once.
STRETCH = 1 << 18
#: Entries of a memo before it starts anew; longer pieces aren't kept.
MEMO, MEMO_PIECE = 1 << 18, 64
#: Ids or bytes of a batch that a task sends on.
BATCH = 1 << 21

# First and last code points of letters and numbers that are newer than the Unicode tables of the tokenizer library.
NEWER = (
    "0558-0558 058b-058c 088f-088f 0c5c-0c5c 0cdc-0cdc 208f-208f 209d-209f a7ce-a7cf a7d2-a7d2 a7d4-a7d4 a7dd-a7dd a7e2-a7e2 a7f1-a7f1 ab6c-ab6d"
    " 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a-11b0a 11db0-11ddb 11de0-11de9 11df1-11df1 1246f-1246f 12475-1247f 12550-12686 16ea0-16eb8"
    " 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168-1b168 1d6a6-1d6a6 1df1f-1df24"
    " 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e-2b81e 2cea2-2cead"
    " 323b0-33479 3d000-3fc3f"
)
_newer = "[" + "".join("-".join(f"\\U{int(x, 16):08x}" for x in pair.split("-")) for pair in NEWER.split()) + "]"
_NEWER = regex.compile(_newer)
_PIECE = regex.compile(public_tokenizers.PATTERN)
#: The same pattern, where newer letters and numbers are neither.
_OLDER = regex.compile("(?V1)" + regex.sub(r"\\p\{([LN])\}", lambda m: rf"[\p{{{m[1]}}}--{_newer}]", public_tokenizers.PATTERN))
#: Texts without characters from here on (and so without newer ones) take the same pattern with its classes spelled out, which is quicker.
_FAR = re.compile("[\u0250-\U0010ffff]")
_near = {kind: "".join(re.escape(chr(c)) for c in range(0x250) if regex.match(rf"\p{{{kind}}}", chr(c))) for kind in "LN"}
_spaces = "".join(re.escape(chr(c)) for c in range(0x250) if regex.match(r"\s", chr(c)))
_NEAR = re.compile(re.sub(r"(?<!\[\^)\\([sS])", lambda m: f"[{'^' * (m[1] == 'S')}{_spaces}]", public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", "[^" + _spaces + _near["L"] + _near["N"] + "]").replace(r"\p{L}", f"[{_near['L']}]").replace(r"\p{N}", f"[{_near['N']}]")))
_BORDER = regex.compile(r"(?<=\S)(?=\s)")


def read_ranks(path: str) -> dict[bytes, int]:
    """A file with a token in base64 and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def stretches(text: str) -> Iterator[str]:
    """The text in order, cut before white space only."""
    at = 0
    while len(text) - at > STRETCH:
        border = _BORDER.search(text, at + STRETCH)
        if not border:
            break
        yield text[at : border.start()]
        at = border.start()
    yield text[at:]


def pieces(text: str) -> Iterator[str]:
    """Each match of the pattern."""
    kind = lambda part: _NEAR if not _FAR.search(part) else _OLDER if _NEWER.search(part) else _PIECE
    return chain.from_iterable(kind(part).findall(part) for part in stretches(text))


class Vocabulary:
    """Tokens by rank, the two parts that each was merged from, and what encoding needs of them."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing or len(set(ranks.values())) < len(ranks):
            raise ValueError(f"the vocabulary lacks bytes ({missing[:3]}) or has ranks twice")
        self.ids = ranks
        self.parts: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        self._together: dict[int, bool] = {}
        self._edges: tuple[dict, dict] = ({}, {})
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            for cut in range(1, len(token)):
                pair = (ranks.get(token[:cut], rank), ranks.get(token[cut:], rank))
                if max(pair) < rank and self.compatible(*pair):
                    self.parts[rank], self.merges[pair] = pair, rank
                    break
        self._together.clear()  # of tokens before the later merges were known

    def __getstate__(self) -> dict[bytes, int]:
        return {"ids": self.ids, "parts": self.parts, "merges": self.merges}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._together, self._edges = {}, ({}, {})

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The parts along one edge of a token, from the whole down to a byte, and the rank of the merge that ends each."""
        known = self._edges[side].get(token)
        if known is None:
            known, ends = [(token, float("inf"))], token
            while parts := self.parts.get(ends):
                known.append((parts[side], ends))
                ends = parts[side]
            self._edges[side][token] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Do the merges leave these two tokens as they are, side by side?"""
        key = left << 32 | right
        known = self._together.get(key)
        if known is None:
            if len(self._together) >= MEMO:
                self._together.clear()
            known = self._together[key] = not self._crossed(left, right)
        return known

    def _crossed(self, left: int, right: int) -> bool:
        merges, after = self.merges, self._edge(right, 0)
        for a, a_ends in self._edge(left, 1):
            for b, b_ends in after:
                if b < a_ends and a < b_ends:  # else one ends before the other is there
                    merged = merges.get((a, b))
                    if merged is not None and merged < a_ends and merged <= b_ends:
                        return True
        return False

    @property
    def token(self) -> dict[int, bytes]:
        if "_token" not in self.__dict__:
            self._token = {rank: token for token, rank in self.ids.items()}
        return self._token

    @property
    def trie(self) -> ahocorasick.Automaton:
        """Of the tokens that merges reach."""
        if "_trie" not in self.__dict__:
            reached = {t.decode("latin-1"): r for t, r in self.ids.items() if len(t) == 1 or r in self.parts}
            self._trie = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            self._longest: dict[str, int] = {}
            for token, rank in reached.items():
                self._trie.add_word(token, rank)
                for n in range(1, len(token) + 1):  # what the trie finds is a beginning of some token; the longest token in that
                    self._longest[token[:n]] = reached.get(token[:n], self._longest.get(token[: n - 1], -1))
            self._size = {r: len(t) for t, r in reached.items()}
            self._shorter = {r: self._longest.get(t[:-1], -1) for t, r in reached.items()}
            self._widest = max(map(len, reached))
        return self._trie

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        if (whole := self.ids.get(piece)) is not None:
            return [whole]
        if not piece:
            return []
        prefix, longest, size, shorter, widest, together = self.trie.longest_prefix, self._longest, self._size, self._shorter, self._widest, self._together
        text = piece.decode("latin-1")
        out: list[int] = []
        at, last, alive, ahead = 0, -1, bytearray(b"\x01") * (len(text) + 1), text[:widest]
        token = longest[ahead[: prefix(ahead)]]
        while True:
            if alive[to := at + size[token]]:
                fits = last < 0 or together.get(last << 32 | token)
                if fits is None:
                    fits = self.compatible(last, token)
                if fits:
                    out.append(token)
                    if to == len(text):
                        return out
                    at, last, ahead = to, token, text[to : to + widest]
                    token = longest[ahead[: prefix(ahead)]]
                    continue
            token = shorter[token]
            while token < 0:
                alive[at] = 0
                at -= size[last]
                token = shorter[out.pop()]
                last = out[-1] if out else -1

    def encoder(self) -> _Memo:
        if "_memo" not in self.__dict__:
            self._memo = _Memo(self)
        return self._memo

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.encoder().__getitem__, pieces(text))), np.int32)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class _Memo(dict):
    """The ids of pieces that came before, as the bytes of 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        found = array("i", self.vocabulary.encode_piece(piece.encode("utf-8", "surrogatepass"))).tobytes()
        if len(piece) <= MEMO_PIECE:
            if len(self) >= 2 * MEMO:
                self.clear()
            self[piece] = found
        return found


def _mapped(rows: DataFrame, source: Column, column: str, kind: T.DataType, make: Callable, size: Callable) -> DataFrame:
    """rows with one more column, made from the source in batches of bounded size; a column of that name is replaced."""
    kept, last = [c for c in rows.columns if c != column], "_" * (1 + max(map(len, rows.columns)))
    schema = T.StructType([*rows.select(*kept).schema.fields, T.StructField(column, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, total = 0, [], 0
            for i, value in enumerate(batch.column(batch.num_columns - 1)):
                held.append(make(value))
                total += size(held[-1])
                if total >= BATCH or i == batch.num_rows - 1:
                    own = batch.slice(first, len(held))
                    yield pa.RecordBatch.from_arrays([*own.columns[:-1], _column(held, kind)], names=[*kept, column])
                    first, held, total = i + 1, [], 0

    return rows.select(*kept, source.alias(last)).mapInArrow(run, schema)


def _column(held: list, kind: T.DataType) -> pa.Array:
    if isinstance(kind, T.BinaryType):
        return pa.array(held, pa.binary())
    offsets = np.cumsum([0, *map(len, held)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(held)))


def encode_texts(rows: DataFrame, path: str = VOCABULARY, text: str = "text", ids: str = "ids") -> DataFrame:
    """rows with the token ids of each text."""
    sent = rows.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(path)))
    return _mapped(rows, F.col(text).cast("string"), ids, T.ArrayType(T.IntegerType()), lambda x: sent.value.encode(x.as_py() or ""), len)


def decode_ids(rows: DataFrame, path: str = VOCABULARY, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """rows with the bytes that each array of ids stands for; a null array or id gives null."""
    sent = rows.sparkSession.sparkContext.broadcast({rank: token for token, rank in read_ranks(path).items()})

    def make(value: pa.Scalar) -> bytes | None:
        if not value.is_valid or value.values.null_count:
            return None
        return b"".join(map(sent.value.__getitem__, value.values.to_numpy().tolist()))

    return _mapped(rows, F.col(ids).cast("array<int>"), decoded, T.BinaryType(), make, lambda x: len(x or b""))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ids")
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decode_ids(encoded).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
