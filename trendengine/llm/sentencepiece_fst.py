"""SentencePiece encoding and decoding by shortest paths through a weighted transducer.

Machines are compiled from a model file and composed with each text:

* the normaliser: the rules of the model (the longest that fits at a place, else the character itself), blanks to U+2581, one
  blank in front; where the model says so, runs of blanks become one;
* the pieces: an Aho-Corasick machine whose arcs spell a piece; where no arc ends on a path, the byte fallback spells a
  character as its UTF-8 bytes;
* the weights of the arcs, by the kind of model.

Weights add along a path and the least sum wins (the tropical semiring).

* Unigram models: an arc weighs what its piece does, minus its score. One pass from left to right relaxes the arcs that end at
  each place (`PieceWeights`). Of equal sums the arc that starts first wins. Sums are of double precision; among paths of equal weight,
  such as one piece before or after another in a run of blanks, the public library's rounding may pick another one.
* Byte-pair models: an arc from piece p to piece q weighs 0 where merging the characters of p + q gives back p, q, and is of
  infinite weight otherwise (`PairWeights`). The first merge across a boundary depends on the two pieces beside it only, so
  exactly one path has finite weight for every prefix, and that path is what merging the whole text by rank would give. It is
  found left to right, one piece per position.

No piece of these models holds a blank after another character, so a text is composed blank by blank, and the paths of repeated
words are remembered, up to twice `CACHE` words per worker; a batch of texts is composed by its different words. Pieces that the user defined are cut out first in byte-pair models.

Runs of blanks and other merges of equal rank depend on position, not on rank: words of byte-pair models with two or more blanks
in front are merged by rank directly.

Narrow: one pass, no shuffle; the model (about half a MB, checked against `MODEL_BYTES`) is broadcast. A null text gives null ids,
an empty one no ids; texts of any length are taken whole, with memory in proportion. Rows are independent: repeated rows and ids
give repeated results. Other columns keep their names and values, what is added gets underscores where its name is taken. Without
rules decoding gives back the text, but for U+2581 itself, which reads as a blank; with rules, the normalised text.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trendengine.llm.common import any_columns, fresh, table, with_column

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MODEL_BYTES = 16 << 20
CACHE = 250_000
PAIRS = 500_000
BLANK = "▁"
#: Fixed values of the model file: types of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BYTE_PAIR = 1, 2
#: Fixed value: what an unknown character costs beyond the worst piece.
UNKNOWN_COST = 10.0


class Model(NamedTuple):
    pieces: list[tuple[str, float, int]]  # (piece, score, type) by id
    kind: int
    rules: bytes  # of the normaliser: a double array of keys, then their replacements
    dummy: bool  # a blank goes in front
    squeeze: bool  # runs of blanks become one, those at the ends none
    escape: bool  # blanks become U+2581
    fallback: bool  # unknown characters are spelled as bytes
    surface: bytes  # what an unknown piece reads as


def _fields(blob: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = blob[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(blob):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
        yield tag >> 3, blob[at : at + size]
        at += size


def read_model(blob: bytes) -> Model:
    """The parts of a model file. Raises where it asks for more than the machines above."""
    pieces, trainer, normaliser = [], {}, {}
    for number, value in _fields(blob):
        if number == 1:
            one = dict(_fields(value))
            pieces.append((one[1].decode(), struct.unpack("<f", one[2])[0] if 2 in one else 0.0, one.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normaliser = dict(_fields(value))
    kind, types = trainer.get(3, UNIGRAM), {t for _, _, t in pieces}
    if kind not in (UNIGRAM, BYTE_PAIR) or UNKNOWN not in types or trainer.get(24, 0):
        raise ValueError("neither a byte-pair nor a unigram model with blanks in front of words")
    if kind == BYTE_PAIR and UNUSED in types:
        raise ValueError("a byte-pair model with unused pieces")
    if kind == UNIGRAM and USER_DEFINED in types:
        raise ValueError("a unigram model with pieces defined by the user")
    if any(BLANK in p.lstrip(BLANK) for p, _, t in pieces if t == NORMAL):
        raise ValueError("pieces span words")
    dummy, squeeze, escape = (bool(normaliser.get(n, 1)) for n in (3, 4, 5))
    surface = trainer.get(44, b" \xe2\x81\x87 ")
    return Model(pieces, kind, normaliser.get(2, b""), dummy, squeeze, escape, bool(trainer.get(35, 0)), surface)


def read_rules(blob: bytes) -> dict[str, str]:
    """Replacements by key of a normaliser's rules: the length of a double array, its units, and the replacements, each behind a zero."""
    import numpy as np

    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64)
    texts, labels, rules = blob[4 + size :], np.arange(1, 256), {}

    def base(node: int) -> int:
        unit = int(units[node])
        return node ^ ((unit >> 10) << ((unit & 512) >> 6))

    open_nodes = [(base(0), b"")]
    while open_nodes:
        at, key = open_nodes.pop()
        nodes = at ^ labels
        inside = nodes < len(units)
        found = units[np.where(inside, nodes, 0)]
        for label in labels[inside & (found & 0x800000FF == labels)].tolist():
            child, longer = at ^ label, key + bytes([label])
            if units[child] >> 8 & 1:
                start = int(units[base(child)]) & 0x7FFFFFFF
                rules[longer.decode()] = texts[start : texts.index(b"\0", start)].decode()
            open_nodes.append((base(child), longer))
    return rules


class Normaliser:
    """Text to the characters that pieces spell. Pieces of the user are left as they are."""

    def __init__(self, model: Model):
        self.dummy, self.squeeze, self.escape = model.dummy, model.squeeze, model.escape
        self.rules = read_rules(model.rules) | {p: p for p, _, kind in model.pieces if kind == USER_DEFINED}
        self.longest: dict[str, int] = {}
        for key in self.rules:
            self.longest[key[0]] = max(len(key), self.longest.get(key[0], 0))
        #: whether a text comes out as it is, with blanks replaced and one in front
        self.plain = self.dummy and not self.squeeze and self.escape and all(k == v for k, v in self.rules.items())

    def _segments(self, text: str) -> Iterator[str]:
        at, longest, rules = 0, self.longest.get, self.rules
        while at < len(text):
            for size in range(longest(text[at], 0), 0, -1):
                found = rules.get(text[at : at + size])
                if found is not None:
                    break
            else:
                found, size = text[at], 1
            yield found
            at += size

    def __call__(self, text: str) -> str:
        if not text:
            return text
        out, after_blank = [], self.squeeze
        for part in self._segments(text) if self.rules else text:
            if after_blank:
                part = part.lstrip(" ")
            if part:
                out.append(part)
                after_blank = self.squeeze and part.endswith(" ")
        mark = BLANK if self.escape else " "
        found = mark * self.dummy + "".join(out).replace(" ", mark)
        return found.rstrip(mark) if self.squeeze else found


class Transducer:
    """What both kinds of model share; `path` gives the ids of the shortest path through a word."""

    def __init__(self, model: Model):
        import ahocorasick

        pieces = model.pieces
        self.normalise = Normaliser(model)
        self.rank = {p: score for p, score, kind in pieces if kind == NORMAL}
        self.id = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.spell = [p for p, _, _ in pieces]
        self.user = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == USER_DEFINED}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.user, key=len, reverse=True))) + ")") if self.user else None
        spelled = (NORMAL, USER_DEFINED)
        self.bytes_of = [p.replace(BLANK, " ").encode() if kind in spelled else b"" for p, _, kind in pieces]
        #: pieces that lose the blank in front where a text begins with them
        self.leads = {i for i, (p, _, kind) in enumerate(pieces) if kind in spelled and p.startswith(BLANK)} if model.dummy or model.squeeze else set()
        self.unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN)
        self.bytes_of[self.unknown] = model.surface
        self.byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE} if model.fallback else {}
        for value, i in self.byte.items():
            self.bytes_of[i] = bytes([value])
        self.machine = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.machine.add_word(p, (i, len(p)))
        self.machine.make_automaton()
        self.length = [len(p) for p in self.spell]
        self.young: dict[str, list[int]] = {}  # paths by word without its blank: those met of late, and those before
        self.old: dict[str, list[int]] = {}

    def path(self, word: str) -> list[int]:
        raise NotImplementedError

    def _bytes(self, character: str) -> list[int]:
        """An unknown character as its bytes, or as one unknown piece where the model has none."""
        return [self.byte[b] for b in character.encode()] if self.byte else [self.unknown]

    def _word(self, word: str) -> list[int]:
        return self.path(word)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        words = text.split(" ") if self.normalise.plain and not self.user else None
        if words is None or BLANK in text or "" in words:
            return self._encode_normalised(self.normalise(text))
        return self._joined(list(chain.from_iterable(map(self._known, words))))

    def _known(self, word: str) -> list[int]:
        """The path of a word with a blank in front, remembered if the word is not long."""
        ids = self.young.get(word)
        if ids is None:
            ids = self.old.get(word)
            if ids is None:
                ids = self.path(BLANK + word)
            if len(word) < 40:
                if len(self.young) >= CACHE:
                    self.old, self.young = self.young, {}
                self.young[word] = ids
        return ids

    def encode_all(self, texts):
        """The ids of an Arrow column of texts as a list column. Its words are numbered first and each is composed once."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.normalise.plain and not self.user and self.byte:
            lists = pc.split_pattern(texts, " ")
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
            words = lists.flatten().dictionary_encode()
            different = words.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist
            odd = np.array([not w or BLANK in w for w in different], bool)
            paths = [[] if skip else self._known(w) for w, skip in zip(different, odd.tolist())]
            starts = np.cumsum([0, *map(len, paths)])
            flat = np.fromiter(chain.from_iterable(paths), np.int32, starts[-1])
            taken = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat)).take(words.indices)
            places, values = taken.offsets.to_numpy()[ends], taken.values.to_numpy()
            strange = np.concatenate([[0], np.cumsum(odd[words.indices.to_numpy()])])[ends]
            rows = np.flatnonzero(strange[1:] > strange[:-1])
        else:
            places, values, rows = np.zeros(len(texts) + 1, np.int64), np.empty(0, np.int32), np.arange(len(texts))
        sizes, parts, done = np.diff(places), [], 0
        for row in rows.tolist():  # texts with runs of blanks or a U+2581 are composed one by one
            own = np.array(self.encode(texts[row].as_py() or ""), np.int32)
            parts += [values[places[done] : places[row]], own]
            sizes[row], done = len(own), row + 1
        values = np.concatenate([*parts, values[places[done] : places[-1]]])
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()), mask=texts.is_null())

    def decode_all(self, lists):
        """The texts of a list column that `encode_all` made."""
        import numpy as np
        import pyarrow as pa

        if self.normalise.squeeze:
            return pa.array([None if ids is None else self.decode(ids) for ids in lists.to_pylist()], pa.string())
        places, values = lists.offsets.to_numpy(), lists.values
        spelled = pa.array(self.bytes_of, pa.large_binary()).take(values)
        _, ends, data = spelled.buffers()
        ends = np.frombuffer(ends, np.int64, len(values) + 1)
        data = np.frombuffer(data, np.uint8, ends[-1]) if ends[-1] else np.empty(0, np.uint8)
        filled = np.flatnonzero(places[1:] > places[:-1])
        firsts = places[filled]
        lead = np.isin(values.to_numpy()[firsts], list(self.leads))
        cut = np.zeros(len(places), np.int64)  # the blank in front of each text goes
        cut[filled[lead] + 1] = 1
        kept = np.delete(data, ends[firsts[lead]])
        offsets = (ends[places] - np.cumsum(cut)).astype(np.int64)
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
        try:
            found = found.cast(pa.large_string())
        except pa.ArrowInvalid:  # bytes that are no UTF-8
            found = pa.array([x.decode("utf-8", "replace") for x in found.to_pylist()], pa.large_string())
        return pa.compute.if_else(lists.is_null(), pa.scalar(None, pa.large_string()), found).cast(pa.string())

    def _encode_normalised(self, text: str) -> list[int]:
        out = []
        for k, part in enumerate(self.cut.split(text) if self.cut else [text]):
            words = [] if k % 2 else re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", part)
            out += [self.user[part]] if k % 2 else chain.from_iterable(map(self._word, words))
        return self._joined(out)

    def _joined(self, ids: list[int]) -> list[int]:
        """Without byte pieces a run of unknown characters is one unknown piece."""
        if self.byte or self.unknown not in ids:
            return ids
        return [i for i, before in zip(ids, [-1, *ids]) if i != self.unknown or before != i]

    def decode(self, ids) -> str:
        found, at = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace"), 0
        for i in ids:  # one blank in front of the first piece goes; all of them where runs of blanks are one
            if self.bytes_of[i]:
                at += i in self.leads
                if i not in self.leads or self.bytes_of[i] != b" " or not self.normalise.squeeze:
                    break
        return found[at:]


class PieceWeights(Transducer):
    """Unigram models: the least sum of minus the scores."""

    def __init__(self, model: Model):
        super().__init__(model)
        self.cost = [-score for _, score, _ in model.pieces]
        self.strange = UNKNOWN_COST - min(self.rank.values(), default=0.0)

    def path(self, word: str) -> list[int]:
        far, cost = float("inf"), self.cost
        least = [0.0] + [far] * len(word)  # by place: the least sum up to it, and the arc that it ends with
        arc: list[tuple[int, int]] = [(-1, 1)] * (len(word) + 1)
        arcs, done = self.machine.iter(word), 0

        def close(place: int) -> None:
            """An unknown character leads where no piece of one character does."""
            nonlocal done
            while done < place:
                done += 1
                if not alone[done] and least[done - 1] + self.strange < least[done]:
                    least[done], arc[done] = least[done - 1] + self.strange, (-1, 1)

        alone = [False] * (len(word) + 1)
        for last, token in arcs:  # by end, and of one end those that start first come first
            end = last + 1
            close(last)
            i, length = token
            alone[end] = alone[end] or length == 1
            total = least[end - length] + cost[i]
            if total < least[end]:
                least[end], arc[end] = total, token
        close(len(word))
        at, out = len(word), []
        while at:
            i, length = arc[at]
            out += reversed(self._bytes(word[at - 1])) if i < 0 else (i,)
            at -= length
        return out[::-1]


class PairWeights(Transducer):
    """Byte-pair models: arcs of weight 0 or infinity by the pair of pieces that they join."""

    def __init__(self, model: Model):
        super().__init__(model)
        self._forget()

    def merge(self, text: str) -> list[str]:
        """The pieces that merging by rank makes of a text: best rank first, leftmost among equals."""
        parts, n = list(text), len(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[float, int, int]] = []  # rank, left part, length of both

        def propose(i: int) -> None:
            if i >= 0 and after[i] < n:
                both = parts[i] + parts[after[i]]
                if both in self.rank:
                    heappush(queue, (-self.rank[both], i, len(both)))

        for i in range(n):
            propose(i)
        while queue:
            _, i, size = heappop(queue)
            j = after[i] if parts[i] else n
            if j >= n or len(parts[i]) + len(parts[j]) != size:
                continue  # one of the two has been merged since
            parts[i] += parts[j]
            parts[j] = ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            propose(before[i])
            propose(i)
        return [p for p in parts if p]

    def _pair(self, row: dict[int, bool], left: int, right: int) -> bool:
        """Whether the arc from ``left`` (-1 at the start, below -1 an unknown character) to ``right`` has weight 0."""
        p, q = self._string(left), self.spell[right]
        row[right] = self.merge(p + q) == ([p, q] if p else [q])
        self.pairs += 1
        return row[right]

    def _string(self, token: int) -> str:
        return self.spell[token] if token >= 0 else "" if token == -1 else chr(-token - 2)

    def _forget(self) -> None:
        """Start with no arc between pieces known: ``rows`` by piece, ``rare`` for the start and unknown characters."""
        self.rows: list[dict[int, bool]] = [{} for _ in self.spell]
        self.rare: dict[int, dict[int, bool]] = {-1: {}}
        self.pairs = 0

    def path(self, word: str) -> list[int]:
        """Ids on the path of finite weight through ``word``."""
        if self.pairs >= PAIRS:
            self._forget()
        # by last character: the piece of the path that ends there, and the row of arcs from it; the start is at -1
        last, rows = [-1] * (len(word) + 1), [None] * len(word) + [self.rare[-1]]
        of = self.rows
        for end, (token, length) in self.machine.iter(word):
            if rows[end] is not None:
                continue  # the path to this position is known
            start = end - length
            row = rows[start]
            if row is None:  # no piece ends there
                row = self._fall_back(word, start, last, rows)
            ok = row.get(token)
            if self._pair(row, last[start], token) if ok is None else ok:
                last[end], rows[end] = token, of[token]
        at, out = len(word) - 1, []
        while at >= 0:
            if rows[at] is None:
                self._fall_back(word, at, last, rows)
            token = last[at]
            if token >= 0:
                out.append(token)
                at -= self.length[token]
            else:
                out += reversed(self._bytes(word[at]))
                at -= 1
        out.reverse()
        return out

    def _fall_back(self, word: str, at: int, last: list, rows: list) -> dict[int, bool]:
        """The character at ``at`` is spelled as bytes."""
        last[at] = -ord(word[at]) - 2
        rows[at] = self.rare.setdefault(last[at], {})
        return rows[at]

    def ranked(self, word: str) -> list[int]:
        """Ids by merging directly."""
        out = []
        for p in self.merge(word):
            out += [self.id[p]] if p in self.id else self._bytes(p)
        return out

    def _word(self, word: str) -> list[int]:
        return self.ranked(word) if word.startswith(BLANK * 2) else self.path(word)


def compiled(model: Model) -> Transducer:
    return PieceWeights(model) if model.kind == UNIGRAM else PairWeights(model)


def _model(spark: SparkSession, path: str):
    """A digest of the model file and its parts, read on the driver, as a broadcast."""
    with open(path, "rb") as file:
        blob = file.read(MODEL_BYTES + 1)
    if len(blob) > MODEL_BYTES:
        raise ValueError(f"the model is over {MODEL_BYTES} bytes")
    return spark.sparkContext.broadcast((hashlib.sha256(blob).hexdigest(), read_model(blob)))


_held: list = []  # the transducer of this Python worker, kept from task to task


def _transducer(sent) -> Transducer:
    key, model = sent.value
    if not _held or _held[0] != key:
        _held[:] = [key, compiled(model)]
    return _held[1]


def _apply(sent, decoded: bool):
    def make():
        import pyarrow as pa

        machine = _transducer(sent)

        def work(columns):
            ids = machine.encode_all(columns[0])
            return pa.StructArray.from_arrays([ids, machine.decode_all(ids)], ["ids", "decoded"]) if decoded else ids

        return work

    return make


def encode(spark: SparkSession, docs: DataFrame, model: str = MODEL, name: str = "ids") -> DataFrame:
    """``docs`` and the ids of each text as an array ``name``."""
    return with_column(docs, ["text"], name, StructType.fromDDL("x array<int>")[0].dataType, _apply(_model(spark, model), False))


def decode(spark: SparkSession, docs: DataFrame, model: str = MODEL, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``docs`` and the text of each array of ids as ``name``."""
    sent = _model(spark, model)

    def make():
        machine = _transducer(sent)
        return lambda columns: [None if x is None else machine.decode(x) for x in columns[0].to_pylist()]

    return with_column(docs, [ids], name, StructType.fromDDL("x string")[0].dataType, make)


def round_trip(spark: SparkSession, docs: DataFrame, model: str = MODEL, name: str = "pieces") -> DataFrame:
    """``docs`` and a struct ``name`` of ids and the text decoded from them, in one pass."""
    kind = StructType.fromDDL("x struct<ids:array<int>,decoded:string>")[0].dataType
    return with_column(docs, ["text"], name, kind, _apply(_model(spark, model), True))


@any_columns("text")
def with_ids(spark: SparkSession, docs: DataFrame, model: str = MODEL) -> DataFrame:
    """The documents with ids and n_ids."""
    ids = fresh("ids", docs)
    return encode(spark, docs, model, ids).withColumn(fresh("n_ids", docs), F.coalesce(F.size(ids), F.lit(0)).cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of ids, digests of the ids (comma-joined) and of the decoded text, and whether that is the text."""
    found = round_trip(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    ids = F.col("pieces.ids")
    return found.select(
        "doc_id",
        F.coalesce(F.size(ids), F.lit(0)).cast("long").alias("n_ids"),
        F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("pieces.decoded"), 256).alias("decoded_sha256"),
        F.col("pieces.decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )
