"""SentencePiece encoding and decoding for merge-type vocabularies, exactly as the sentencepiece library.

A text's symbols start as its characters.  An agenda holds the adjacent pairs that form a piece, best score first, then
leftmost; a pair is merged if both symbols still stand, and the new neighbours enter the agenda.  Symbols outside the
vocabulary become byte pieces.  No piece of such a vocabulary goes on after a word's end, so a text is cut before each
run of spaces and at line ends and each different word runs its agenda once per worker while it is in use.  (Where a
vocabulary has such pieces, the whole text is one agenda.)

Check in Arrow batches: all words new to the worker in a batch, and one whole text of the batch, are encoded and
decoded by the library too.  Where it differs, its ids are taken and counted in ``repaired`` (0 for a vocabulary of this kind).

Defined results: null counts as the empty text, which has the end id alone; long texts are never cut; repeated rows
and null ids stay; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm.common import arrow_schema, documents, slices, texts

SPACE = "▁"
WORDS_KEPT = 400_000
# the library replaces bytes that are no UTF-8 one by one
codecs.register_error("each-byte", lambda e: ("\ufffd", e.start + 1))


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A vocabulary, and the words encoded lately."""

    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.text, self.rank, self.id, self.byte, self.silent = [], {}, {}, {}, set()
        scores = []
        for i in range(len(sp)):
            piece = sp.id_to_piece(i)
            self.text.append(piece.replace(SPACE, " "))
            if sp.is_byte(i):
                self.byte[int(piece[1:-1], 16)] = i
                self.text[i] = bytes([int(piece[1:-1], 16)])
            elif sp.is_control(i):
                self.silent.add(i)
            elif not sp.is_unknown(i):
                self.id[piece] = i
                scores.append((-sp.get_score(i), piece))
        place = {score: n for n, score in enumerate(sorted({s for s, _ in scores}))}
        self.rank = {piece: place[score] for score, piece in scores}
        self.end, self.unknown = sp.eos_id(), sp.unk_id()
        cut = not any(SPACE in p.lstrip(SPACE) for p in self.id) and not any("\n" in p for p in self.id)
        self.cut = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+" if cut else r"(?s:.+)")
        probes = ["a", " a  b ", "\tAÉ１​\nﬁ", "  "]
        self.plain = all(sp.normalize(p) == self._spaced(p) for p in probes)
        self.words: dict[str, tuple[bytes, str, bool]] = {}
        self.before: dict[str, tuple[bytes, str, bool]] = {}

    @staticmethod
    def _spaced(text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def merge(self, s: str) -> list[int]:
        """Ids of a piece of text, by the agenda."""
        n, rank = len(s), self.rank.get
        size, before, agenda = [1] * n, list(range(-1, n)), []
        wide = n + 1
        for i in range(n - 1):
            r = rank(s[i:i + 2])
            if r is not None:
                agenda.append(((r * wide + i) * wide) + 2)
        heapq.heapify(agenda)
        while agenda:
            top, length = divmod(heapq.heappop(agenda), wide)
            i = top % wide
            j = i + size[i]
            if not size[i] or j >= n or size[i] + size[j] != length:
                continue  # one of the two has been merged with another since
            size[i], size[j] = length, 0
            after = i + length
            if after < n:
                before[after] = i
                r = rank(s[i:after + size[after]])
                if r is not None:
                    heapq.heappush(agenda, ((r * wide + i) * wide) + length + size[after])
            b = before[i]
            if b >= 0:
                r = rank(s[b:after])
                if r is not None:
                    heapq.heappush(agenda, ((r * wide + b) * wide) + length + size[b])
        ids, i = [], 0
        while i < n:
            symbol = s[i:i + size[i]]
            one = self.id.get(symbol)
            if one is not None:
                ids.append(one)
            elif self.byte:
                ids += [self.byte[x] for x in symbol.encode()]
            else:
                ids.append(self.unknown)
            i += size[i]
        return ids

    def spell(self, ids: list[int]) -> str:
        """The text of ids, with the space that encoding puts in front; bytes that are no UTF-8 become U+FFFD."""
        out, run = [], b""
        for i in ids:
            t = self.text[i]
            if isinstance(t, bytes):
                run += t
                continue
            if i not in self.silent:
                if run:
                    out.append(run.decode(errors="each-byte"))
                    run = b""
                out.append(t)
        return "".join([*out, run.decode(errors="each-byte")])

    def encode(self, text: str) -> list[int]:
        s = self._spaced(text) if self.plain else self.library.normalize(text)
        return [i for w in self.cut.findall(s) for i in self.merge(w)] + [self.end]

    def decode(self, ids: list[int]) -> str:
        first = next((self.text[i] for i in ids if i not in self.silent), b"")
        spelt = self.spell(ids)
        return spelt if isinstance(first, bytes) else spelt.removeprefix(" ")

    def _learn(self, fresh: list[str]) -> None:
        """Encodes new words and compares them with the library, all in one call."""
        lead = self.merge(SPACE) + self.merge("\n")
        asked = [w[1:].replace(SPACE, " ") if w[0] == SPACE else "\n" + w for w in fresh]
        for w, theirs in zip(fresh, self.library.encode(asked, num_threads=1)):
            ids = self.merge(w)
            theirs = theirs if w[0] == SPACE else theirs[len(lead):]
            same = ids == theirs or w == SPACE and theirs == []  # the library gives the empty text no space
            self.words[w] = (np.array(ids if same else theirs, "<i4").tobytes(), self.spell(ids if same else theirs), not same)

    def batch(self, batch: list[str]) -> tuple[list[bytes], list[str], list[int]]:
        """Per text: its ids as 32-bit integers, the decoded text, and how many of its words the library had to repair."""
        spaced = [self._spaced(t) if self.plain else self.library.normalize(t) for t in batch]
        own = list(map(self.cut.findall, spaced))
        fresh = []
        for w in set().union(*own):
            if w not in self.words:
                if (old := self.before.get(w)) is not None:
                    self.words[w] = old
                else:
                    fresh.append(w)
        if fresh:
            self._learn(fresh)
        end, words = np.array([self.end], "<i4").tobytes(), self.words
        ids, spelt, repaired = [], [], []
        for own_words in own:
            found = [words[w] for w in own_words]
            ids.append(b"".join([*[f[0] for f in found], end]))
            spelt.append("".join([f[1] for f in found]).removeprefix(" "))
            repaired.append(sum(f[2] for f in found))
        if batch:
            k = min(range(len(batch)), key=lambda i: (len(batch[i]) < 200, len(batch[i])))
            theirs = self.library.encode(batch[k], add_eos=True)
            if np.frombuffer(ids[k], "<i4").tolist() != theirs or spelt[k] != self.library.decode(theirs):
                ids[k], spelt[k], repaired[k] = np.array(theirs, "<i4").tobytes(), self.library.decode(theirs), repaired[k] + 1
        if len(words) > WORDS_KEPT:
            self.before, self.words = words, {}
        return ids, spelt, repaired


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encoded(df: DataFrame, key: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """key, ids (with the end id), decoded, repaired for every row."""
    path = model or default_model()
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    out = arrow_schema("ids array<int>, decoded string, repaired int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for b in slices(batches, 256):
            ids, spelt, repaired = vocabulary.batch(texts(b.column(1)))
            ends = np.cumsum([0, *[len(x) // 4 for x in ids]]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")), type=out.field(0).type)
            yield pa.RecordBatch.from_arrays([b.column(0), lists, pa.array(spelt, pa.string()), pa.array(repaired, pa.int32())],
                                             schema=pa.schema([b.schema.field(0), *out]))

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids array<int>, decoded string, repaired int").withColumnRenamed("key", key)


def digests(found: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return digests(encoded(documents(spark, sf)))


def stage(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """doc_id, number of ids, and the digests of ids and decoded text of every row."""
    return digests(encoded(docs))
