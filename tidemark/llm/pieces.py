"""SentencePiece encoding as a shortest path through weighted transducers, and decoding.

The normaliser writes a space as the word mark and puts one before the text. The lexicon transducer
accepts each piece of the model at the cost of its score, and any character as its UTF-8 byte pieces at
a cost above that of all pieces. Composed with the chain of a text's characters this is a graph over
places in the text; its shortest path in the tropical semiring (least sum of costs) is the encoding.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tidemark.llm.common import text_batches

MARK = "▁"
MEMO_UNITS, LONGEST_UNIT = 400_000, 64
#: Characters that are encoded together, and rows that are decoded together.
TAKEN_CHARS, DECODED_ROWS = 1_000_000, 256


class Transducer:
    """The compiled normaliser, pieces and byte fallback of one model file: all that encoding needs."""

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.byte_ids = [0] * 256
        #: The states of the lexicon: arcs by character, and (id, cost) where a piece ends.
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[tuple[int, float] | None] = [None]
        costs, crossing = [0.0], False
        for i in range(n):
            if model.is_byte(i):
                self.byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = model.id_to_piece(i)
                crossing |= bool(re.search(f"[^{MARK}]{MARK}", piece))
                self._accept(piece, i, -float(model.get_score(i)))
                costs.append(-float(model.get_score(i)))
        self.byte_cost = max(costs) + 1.0
        # No piece holds a mark after another character: paths of such units are independent.
        self.units = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if not crossing else r"(?s).+").findall
        self.memo: dict[str, bytes] = {}

    def _accept(self, piece: str, name: int, cost: float) -> None:
        state = 0
        for ch in piece:
            if ch not in self.arcs[state]:
                self.arcs[state][ch] = len(self.arcs)
                self.arcs.append({})
                self.final.append(None)
            state = self.arcs[state][ch]
        self.final[state] = (name, cost)

    @staticmethod
    def normalise(text: str) -> str:
        """A mark for each space and one before the text; an empty text stays empty."""
        return MARK + text.replace(" ", MARK) if text else ""

    def shortest_path(self, text: str) -> tuple[float, list[int]]:
        """Cost and ids of the cheapest path over a normalised text; ties go to the longer last piece."""
        arcs, final, n = self.arcs, self.final, len(text)
        best = [0.0] + [float("inf")] * n
        back: list[tuple[int, tuple[int, ...]]] = [(0, ())] * (n + 1)
        for at in range(n):
            here, state = best[at], 0
            for to in range(at, n):
                state = arcs[state].get(text[to], 0)
                if not state:
                    break
                end = final[state]
                if end and here + end[1] < best[to + 1]:
                    best[to + 1], back[to + 1] = here + end[1], (at, (end[0],))
            if best[at + 1] > here + self.byte_cost:
                raw = text[at].encode("utf-8", "surrogatepass")
                if here + len(raw) * self.byte_cost < best[at + 1]:
                    best[at + 1] = here + len(raw) * self.byte_cost
                    back[at + 1] = (at, tuple(self.byte_ids[x] for x in raw))
        path, at = [], n
        while at:
            at, ids = back[at]
            path.append(ids)
        return best[n], [i for ids in reversed(path) for i in ids]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers, unit by unit with a memo."""
        out, memo = [], self.memo
        for unit in self.units(self.normalise(text)):
            ids = memo.get(unit)
            if ids is None:
                ids = np.array(self.shortest_path(unit)[1], "<u4").tobytes()
                if len(unit) <= LONGEST_UNIT:
                    if len(memo) >= MEMO_UNITS:
                        memo.clear()
                    memo[unit] = ids
            out.append(ids)
        return b"".join(out)


class Speller:
    """What the pieces of one model file spell: all that decoding needs."""

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        self.spell = [b""] * model.get_piece_size()
        for i in range(len(self.spell)):
            if model.is_byte(i):
                self.spell[i] = bytes([int(model.id_to_piece(i)[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.spell[i] = model.id_to_piece(i).replace(MARK, " ").encode()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the space that the normaliser put before it is taken away."""
        spell = self.spell
        text = b"".join([spell[i] for i in ids.tolist()]).decode("utf-8", "surrogatepass")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def speller(path: str) -> Speller:
    """One speller per worker and file."""
    return Speller(path)


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One compiled transducer per worker and file."""
    return Transducer(path)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, text, ids) of documents (doc_id, text); ids little-endian unsigned 32-bit integers.

    A null text counts as empty and has no ids. Null and repeated doc_ids are kept row by row; other
    columns are ignored.
    """

    def run(batches):
        for keys, texts in text_batches(batches, TAKEN_CHARS):
            fst = transducer(model)
            ids = [fst.encode(t) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(texts, pa.string()), pa.array(ids, pa.binary())], ["doc_id", "text", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, text string, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` (ids, ...) with the column ``decoded`` added; the other columns are kept."""
    place = encoded.columns.index("ids")
    names = [*encoded.columns, "decoded"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)

    def run(batches):
        for batch in batches:
            decode_ids = speller(model).decode
            for at in range(0, batch.num_rows, DECODED_ROWS):
                rows = batch.slice(at, DECODED_ROWS)
                texts = [decode_ids(np.frombuffer(x.as_py() or b"", "<u4")) for x in rows.column(place)]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], names)

    return encoded.mapInArrow(run, f"{fields}, decoded string")
