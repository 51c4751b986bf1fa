"""SentencePiece merge encoding and decoding, exactly, by backtracking over longest matches.

A sequence of tokens is the merge encoding of a text if and only if each token merges to itself and
every two neighbours, merged again from their characters, stay apart where they are. So the encoder
takes the longest token that fits its predecessor, found by one Aho-Corasick pass over the word, goes
back where nothing fits, and marks the position as failed in a bit field so that it is tried once.

Texts are cut into words where no merge can cross (before a space mark that follows another
character, and around line feeds), and each worker remembers the words it met last.

Defined cases: a null or empty text has no ids; ids that are null or empty decode to an empty text;
a null key stays; repeated rows give repeated results; empty tables give no rows; other columns are
ignored. A model other than an identity-normalised merge model with byte fallback is an error.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import remembered, share, shared, table

# The space mark, the replacement for broken bytes, and the text of an unknown id.
SPACE = "▁"
BAD = "�"
UNKNOWN = " ⁇ "
NORMAL, UNK, CONTROL, BYTE = 1, 2, 3, 6
MERGES = 2


@dataclass(frozen=True)
class Pieces:
    """The content of a model file that encoding needs. Small (some 100 kB) and sent to tasks as it is."""

    texts: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: bytes
    prefix: bool
    sound: frozenset[int]
    words: str

    @staticmethod
    def load(path: str) -> Pieces:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm, spec = model.normalizer_spec, model.trainer_spec
        plain = not norm.precompiled_charsmap and not norm.remove_extra_whitespaces and norm.escape_whitespaces
        if spec.model_type != MERGES or not spec.byte_fallback or spec.treat_whitespace_as_suffix or not plain:
            raise ValueError(f"{path} is not an identity-normalised merge model with byte fallback")
        texts, kinds = tuple(p.piece for p in model.pieces), bytes(p.type for p in model.pieces)
        normal = [i for i, k in enumerate(kinds) if k == NORMAL]
        singles = {texts[i] for i in normal if len(texts[i]) == 1}
        inner = any(SPACE in texts[i].lstrip(SPACE) for i in normal)
        if inner or set(kinds) - {NORMAL, UNK, CONTROL, BYTE} or not singles.issuperset("".join(texts[i] for i in normal)):
            raise ValueError(f"{path} has pieces that this encoder does not cover")
        joined = any("\n" in texts[i] and len(texts[i]) > 1 for i in normal)
        words = f"{SPACE}*[^{SPACE}]+|{SPACE}+" if joined else f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"
        every = tuple(p.score for p in model.pieces)
        draft = Pieces(texts, every, kinds, norm.add_dummy_prefix, frozenset(), words)
        sound = frozenset(i for i in normal if draft.merged(texts[i]) == [texts[i]])
        return Pieces(texts, every, kinds, norm.add_dummy_prefix, sound, words)

    @cached_property
    def score_of(self) -> dict[str, float]:
        return {t: s for t, s, k in zip(self.texts, self.scores, self.kinds) if k == NORMAL}

    def merged(self, text: str) -> list[str]:
        """The plain merge loop, for the few characters of one or two tokens."""
        parts, score = list(text), self.score_of
        while True:
            found = [(score[p], -i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in score]
            if not found:
                return parts
            i = -max(found)[1]
            parts[i: i + 2] = [parts[i] + parts[i + 1]]

    def split(self, text: str) -> list[str]:
        """The words of a whole text, as the encoder sees it."""
        if not text:
            return []
        marked = text.replace(" ", SPACE)
        return re.findall(self.words, SPACE + marked if self.prefix else marked)


class Recent(dict):
    """A cache of about the ``2 * limit`` words met last, for one worker."""

    def __init__(self, make, limit: int = 200_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.older = make, limit, longest, {}

    def __missing__(self, word: str):
        value = self.older.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value


class Codec:
    """Encoder and decoder of one model in one worker."""

    def __init__(self, model: Pieces):
        self.model, self.texts = model, model.texts
        self.lengths = [len(t) for t in model.texts]
        # For each token the longest one that it begins with, if there is one.
        sound = {model.texts[i]: i for i in model.sound}
        self.shorter = [-1] * len(model.texts)
        for text, i in sound.items():
            self.shorter[i] = next((sound[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in sound), -1)
        self.known = {t for t in model.score_of if len(t) == 1}
        self.bytes = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(model.texts, model.kinds)) if k == BYTE}
        self.automaton = ahocorasick.Automaton()
        for i in model.sound:
            self.automaton.add_word(model.texts[i], i)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.words = Recent(lambda word: array("i", self.encode_word(word)).tobytes())
        self.forms = Recent(self._forms, limit=300_000)

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart when the characters of both are merged again."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            a, b = self.texts[left], self.texts[right]
            known = self.model.merged(a + b) == [a, b]
            if len(self.pairs) >= 1_000_000:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def _encode_known(self, text: str) -> list[int]:
        """The merge encoding of characters that are all pieces.

        The longest matches in a row are taken while each fits its predecessor. Where one does not, the
        tokens that begin it are tried, from the longest on, and where none fits the position has failed, and the
        token before it is taken back. From a shorter token on, longest matches are taken again.
        """
        fits, lengths, shorter, known = self.fits, self.lengths, self.shorter, self.pairs.get
        tokens: list[int] = []
        at, size, last = 0, len(text), -1
        failed = None
        while True:
            for _, token in self.automaton.iter_long(text, at, size):
                if last >= 0:
                    fit = known(last << 32 | token)
                    if not (fits(last, token) if fit is None else fit):
                        break
                end = at + lengths[token]
                if failed is not None and failed[end >> 3] >> (end & 7) & 1:
                    break
                tokens.append(token)
                last, at = token, end
            if at == size:
                return tokens
            if failed is None:
                failed = bytearray(size // 8 + 1)
            token = shorter[token]
            while True:
                while token >= 0:
                    end = at + lengths[token]
                    if not failed[end >> 3] >> (end & 7) & 1 and (last < 0 or fits(last, token)):
                        break
                    token = shorter[token]
                if token >= 0:
                    break
                failed[at >> 3] |= 1 << (at & 7)
                token = tokens.pop()
                at -= lengths[token]
                last = tokens[-1] if tokens else -1
                token = shorter[token]
            tokens.append(token)
            last, at = token, end
            if at == size:
                return tokens

    def encode_word(self, word: str) -> list[int]:
        if self.known.issuperset(word):
            return self._encode_known(word)
        ids: list[int] = []
        run = ""
        for part in re.split("([" + re.escape("".join(set(word) - self.known)) + "])", word):
            if not part:
                continue
            if part[0] in self.known:
                ids += self._encode_known(part)
            else:
                ids += [self.bytes[b] for b in part.encode()]
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text as 32-bit numbers."""
        return b"".join(map(self.words.__getitem__, self.model.split(text)))

    def _forms(self, word: str) -> tuple[bytes, bytes, bytes]:
        """A word's ids as 32-bit numbers, as decimals with commas, and the bytes that they stand for."""
        ids = self.encode_word(word)
        return array("i", ids).tobytes(), b",".join(map(self.decimals.__getitem__, ids)), b"".join(map(self.surface.__getitem__, ids))

    @cached_property
    def decimals(self) -> list[bytes]:
        return [str(i).encode() for i in range(len(self.texts))]

    def round_trip(self, text: str) -> tuple[bytes, bytes, bytes]:
        """A text's ids as 32-bit numbers and as decimals with commas, and the UTF-8 of the text they decode to.

        Ids are those of the words in a row, so all three are put together from the words' forms.
        """
        forms = list(map(self.forms.__getitem__, self.model.split(text)))
        ids = b"".join([f[0] for f in forms])
        joined = b"".join([f[2] for f in forms])
        try:
            joined.decode()
        except UnicodeDecodeError:
            decoded = self.decode(np.frombuffer(ids, "<i4").tolist()).encode()
        else:
            decoded = joined[self._skipped(np.frombuffer(ids[:4], "<i4").tolist() if ids else []):]
        return ids, b",".join([f[1] for f in forms]), decoded

    def _skipped(self, ids: list[int]) -> int:
        """How many characters of the decoded text stand for the prefix: one space, or none."""
        kinds = self.model.kinds
        first = next((i for i in ids if kinds[i] != CONTROL), None) if self.model.prefix else None
        return int(first is not None and kinds[first] == NORMAL and self.texts[first].startswith(SPACE))

    @cached_property
    def surface(self) -> list[bytes]:
        """The bytes each id stands for. Control ids stand for none, but part the bytes around them: theirs
        is a byte that no text has, so that joined ids with one are taken apart."""
        out = []
        for text, kind in zip(self.texts, self.model.kinds):
            if kind == BYTE:
                out.append(bytes([int(text[3:5], 16)]))
            elif kind == CONTROL:
                out.append(b"\xff")
            else:
                out.append((UNKNOWN if kind == UNK else text.replace(SPACE, " ")).encode())
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids; each byte that belongs to no character becomes U+FFFD."""
        surface, kinds = self.surface, self.model.kinds
        skip = self._skipped(ids)
        joined = b"".join(map(surface.__getitem__, ids))
        try:
            return joined.decode()[skip:]
        except UnicodeDecodeError:
            parts: list[str] = []
            run = b""
            for i in ids:
                if kinds[i] == BYTE:
                    run += surface[i]
                else:
                    parts += [_bytewise(run), "" if kinds[i] == CONTROL else surface[i].decode()]
                    run = b""
            return "".join([*parts, _bytewise(run)])[skip:]


def _bytewise(run: bytes) -> str:
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at: at + size].decode())
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append(BAD)
            size = 1
        at += size
    return "".join(out)


def codec_of(model: Pieces) -> Codec:
    return remembered("codec", (model.texts, model.scores), lambda: Codec(model))


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids`` of every row, encoded as the model at ``path`` does. No shuffle."""
    model = share(docs.sparkSession, Pieces.load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared(model))
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                encoded = [codec.encode(t) if t else b"" for t in part.column(1).to_pylist()]
                offsets = np.cumsum([0, *(len(e) // 4 for e in encoded)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), dtype="<i4")))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[key, "ids"])

    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias("__text"))
    return rows.mapInArrow(run, f"{key} long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, ids, text``: the text of every row's ids. No shuffle."""
    model = share(encoded.sparkSession, Pieces.load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared(model))
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                column = part.column(1)
                texts = [codec.decode(column[i].values.to_pylist()) if column[i].is_valid else "" for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[key, "ids", "text"])

    rows = encoded.select(F.col(key).cast("long").alias(key), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, f"{key} long, ids array<int>, text string")


def round_trips(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of every row: digests of its ids, in decimal with commas, and of the
    text that they decode to. No shuffle; encoding, decoding and both digests are one pass over the text."""
    model = share(docs.sparkSession, Pieces.load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared(model))
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sizes, ids, texts = [], [], []
                for content in part.column(1):
                    numbers, decimals, decoded = codec.round_trip(content.as_py() or "")
                    sizes.append(len(numbers) // 4)
                    ids.append(hashlib.sha256(decimals).hexdigest())
                    texts.append(hashlib.sha256(decoded).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                    names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias("__text"))
    return rows.mapInArrow(run, f"{key} long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return round_trips(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
