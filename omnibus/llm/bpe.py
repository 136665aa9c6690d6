"""BPE encoding and decoding with a contiguous rank array per word.

A word is a row of parts and beside it a row of ranks, one for each adjacent
pair.  The smallest rank is found by scanning, its boundary deleted, and the two
ranks next to it looked up again; no pair table, heap or tree is kept.  Words
longer than ``SCAN_PARTS`` would make the scan quadratic; they go through a
heap with the same merges in the same order.

Vocabulary files are read on the driver, from a path that is a parameter, and
their tables sent to the executors once (bounded by the vocabulary).  Each
Python worker keeps the encodings of recent words, up to ``CACHE_WORDS``.

Texts are brought to Unicode form C as the tokenizers library has it, whose
tables know no combining marks added after version 9.

Defined cases: NULL encodes as the empty text: no ids.  Strings of special
tokens inside a text become those tokens, as the tokenizers library has it.
Ids are unsigned 32-bit, little-endian in the digest.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from functools import cached_property

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCAN_PARTS = 64
CACHE_WORDS = 500_000
CACHE_WORD_LENGTH = 64
#: Ids fit into so many bits.
_BITS = 20
_MASK = (1 << _BITS) - 1
_NONE = 1 << 60

# The split pattern of the vocabulary's pre-tokenizer, and the white space its normalizer replaces.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
# Combining marks that Unicode got after version 9, and the second half of a pair that it composes since.
# The tokenizers library's normalizer is of that version and neither moves them nor composes anything across them.
_LATE = regex.compile(
    "(["
    "\u07FD\u0898-\u089F\u08CA-\u08D3\u09FE\u0C3C\u0D3B-\u0D3C\u0EBA\u1715\u1ABF-\u1ACE\u1DF6-\u1DFA"
    "\uA82C\U00010D24-\U00010D27\U00010EAB-\U00010EAC\U00010EFD-\U00010EFF\U00010F46-\U00010F50"
    "\U00010F82-\U00010F85\U00011070\U0001133B\U0001145E\U00011839-\U0001183A\U00011930"
    "\U0001193D-\U0001193E\U00011943\U000119E0\U00011A34\U00011A47\U00011A99\U00011D42"
    "\U00011D44-\U00011D45\U00011D97\U00011F41-\U00011F42\U00016FF0-\U00016FF1\U0001E08F"
    "\U0001E130-\U0001E136\U0001E2AE\U0001E2EC-\U0001E2EF\U0001E4EC-\U0001E4EF"
    "])"
)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed public vocabulary of this name lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(plain))
    return [letters[b] for b in range(256)]


class WordBpe:
    """A word-level BPE vocabulary: lower case, word ends marked, white space dropped."""

    def __init__(self, text: str):
        content = json.loads(text)
        model = content["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}

    @classmethod
    def from_file(cls, path: str) -> WordBpe:
        with open(path, encoding="utf-8") as f:
            return cls(f.read())

    def __getstate__(self):
        return {"vocab": self.vocab, "merges": self.merges, "special": self.special}

    @cached_property
    def ranks(self) -> dict[int, int]:
        """(left id, right id) -> (rank, id of the merged part), each pair as one integer."""
        ids = self.vocab
        return {ids[a] << _BITS | ids[b]: rank << _BITS | ids[a + b] for rank, (a, b) in enumerate(self.merges)}

    @cached_property
    def first(self) -> list[int]:
        return [self.vocab[c] for c in byte_letters()]

    @cached_property
    def last(self) -> list[int]:
        return [self.vocab[c + WORD_END] for c in byte_letters()]

    @cached_property
    def tokens(self) -> list[bytes]:
        """Each id's string with one space after it; ids without a string decode to nothing."""
        named = {**self.vocab, **self.special}
        out = [b""] * (max(named.values()) + 1)
        for token, i in named.items():
            out[i] = token.encode() + b" "
        return out

    @cached_property
    def pieces(self):
        return regex.compile(PIECE, regex.V0)

    @cached_property
    def too_new(self) -> frozenset[str]:
        """Letters and digits that the pattern's own library knows but Python's older character table doesn't.

        The tokenizers library is of the older table's age and takes them as signs.
        """
        unknown = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
        return frozenset("".join(regex.findall(r"[\p{L}\p{N}]+", unknown)))

    @cached_property
    def strict_pieces(self):
        new = "[" + regex.escape("".join(sorted(self.too_new))) + "]" if self.too_new else "(?!)"
        letter, digit = rf"(?:(?!{new})\p{{L}})", rf"(?:(?!{new})\p{{N}})"
        sign = rf"(?:{new}|[^\s\p{{L}}\p{{N}}])"
        return regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{digit}|{sign}+", regex.V0)

    @cached_property
    def specials(self):
        longest = sorted(self.special, key=len, reverse=True)
        return regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None

    @cached_property
    def cache(self) -> dict[str, bytes]:
        return {}

    def parts(self, word: str) -> list[int]:
        raw = word.encode()
        out = [self.first[b] for b in raw]
        out[-1] = self.last[raw[-1]]
        return out

    def merge(self, parts: list[int]) -> list[int]:
        """The ids of one word."""
        if len(parts) > SCAN_PARTS:
            return self.merge_long(parts)
        look = self.ranks.get
        pairs = [look(a << _BITS | b, _NONE) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) != _NONE:
            at = pairs.index(best)
            parts[at] = merged = best & _MASK
            del parts[at + 1], pairs[at]
            if at < len(pairs):
                pairs[at] = look(merged << _BITS | parts[at + 1], _NONE)
            if at:
                pairs[at - 1] = look(parts[at - 1] << _BITS | merged, _NONE)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        look = self.ranks.get
        n = len(parts)
        after = [*range(1, n), -1]
        before = [-1, *range(n - 1)]
        queue = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (found := look(parts[i] << _BITS | parts[j])) is not None:
                heapq.heappush(queue, (found, i, parts[i], parts[j]))

        for i in range(n):
            offer(i)
        while queue:
            found, i, a, b = heapq.heappop(queue)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = found & _MASK, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            after[j] = -1
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p >= 0]

    def normalize(self, text: str) -> str:
        composed = unicodedata.normalize("NFC", text)
        if composed != text and _LATE.search(text):
            composed = "".join(unicodedata.normalize("NFC", part) for part in _LATE.split(text))
        text = composed
        # Character by character: a capital sigma at a word's end is an ordinary one.
        return text.replace("Σ", "σ").lower()

    def _plain(self, text: str, out: bytearray) -> None:
        text = self.normalize(text)
        start = len(out)
        if not self._pieces(self.pieces.findall(text), out, True):
            del out[start:]
            self._pieces(self.strict_pieces.findall(text), out, False)

    def _pieces(self, pieces: list[str], out: bytearray, watch: bool) -> bool:
        """Append the ids of the pieces; False, if ``watch``, at a piece with a character too new."""
        cache = self.cache
        for piece in pieces:
            ids = cache.get(piece)
            if ids is None:
                if watch and not piece.isascii() and not self.too_new.isdisjoint(piece):
                    return False
                ids = array("I", self.merge(self.parts(piece))).tobytes()
                if watch and len(piece) <= CACHE_WORD_LENGTH:
                    if len(cache) >= CACHE_WORDS:
                        cache.clear()
                    cache[piece] = ids
            out += ids
        return True

    def encode(self, text: str) -> bytes:
        """Ids of the whole text as little-endian unsigned 32-bit integers."""
        out = bytearray()
        if self.specials and "<|" in text:
            for k, part in enumerate(self.specials.split(text)):
                if k % 2:
                    out += array("I", [self.special[part]]).tobytes()
                else:
                    self._plain(part, out)
        else:
            self._plain(text, out)
        return bytes(out)

    def decode(self, ids: bytes) -> bytes:
        """The token strings with a space between them, in UTF-8: this vocabulary names no decoder."""
        return b"".join(map(self.tokens.__getitem__, array("I", ids)))[:-1]


def encoded(docs: DataFrame, vocabulary: WordBpe, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """``keep`` columns and (ids binary, decoded string): every text encoded, then decoded from its ids."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        model = shared.value
        for batch in batches:
            ids, decoded = [], []
            for value in batch.column("_text"):
                found = model.encode(value.as_py() or "")
                ids.append(found)
                decoded.append(model.decode(found).decode())
            kept = batch.select(list(keep))
            yield kept.append_column("ids", pa.array(ids, pa.binary())).append_column(
                "decoded", pa.array(decoded, pa.string())
            )

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, f"{kinds}, ids binary, decoded string")


def digests(docs: DataFrame, vocabulary: WordBpe, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        model = shared.value
        for batch in batches:
            counts, ids, decoded = [], [], []
            for value in batch.column("text"):
                found = model.encode(value.as_py() or "")
                counts.append(len(found) // 4)
                ids.append(hashlib.sha256(found).hexdigest())
                decoded.append(hashlib.sha256(model.decode(found)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
