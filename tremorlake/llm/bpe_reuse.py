"""BPE encoding and decoding with content-defined chunk reuse.

A gear rolling hash cuts each text into chunks wherever its bytes say so, so a passage that documents share
falls into the same chunks wherever it stands. The whole words of a chunk are encoded and decoded once while
they are remembered. Chunks are cut without regard to words: at a join, the two half words are encoded anew
together with whole words on either side, and that window grows by a word at a time until the ids of its
outer words agree exactly with the ids both chunks have there. Words end at spaces and line breaks, which
the tokenizer drops and never joins characters across, so agreement there makes the ids those of the whole text.

A chunk without enough words to agree on is not cut off from its neighbour, and a text that spells a special
token is encoded whole. The memory is bounded; what it has forgotten is encoded again. Rows never leave the
task that reads them.

Defined results: a null or empty text has no ids and decodes to an empty text; rows that repeat a document
get equal answers; an empty table gives an empty result; other columns are not read.
"""

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.llm import gear
from tremorlake.llm.byte_bpe import _byte_of_char
from tremorlake.llm.shipping import ship

#: Mean bytes of a chunk.
CHUNK_BYTES = 512
#: Chunks remembered in one Python worker, in each of two generations; of words beside joins, four times as many.
REMEMBERED = 30_000
#: Texts whose unknown chunks are encoded together.
TEXTS_AT_ONCE = 64
#: Whole words on either side of a join to begin with, and words a chunk must hold to be cut off.
OUTER_WORDS, CHUNK_WORDS = 1, 6

_GAP = re.compile("[ \n]+")

# How the vocabulary's tokenizer splits text, and the same for the characters of Latin text.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LATIN = re.compile("[\n -~À-ÖØ-öø-ÿ]*")
_LATIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


class Memory:
    """Values of keys, computed for many at once; two generations of about ``size`` are kept."""

    def __init__(self, compute, size: int):
        self.compute, self.size = compute, size
        self.young, self.old, self.computed = {}, {}, 0

    def of(self, keys: list) -> list:
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        unknown = []
        for key in dict.fromkeys(keys):
            if key not in young:
                if (value := old.get(key)) is not None:
                    young[key] = value
                else:
                    unknown.append(key)
        self.computed += len(unknown)
        young.update(zip(unknown, self.compute(unknown)))
        return [young[key] for key in keys]


class Merger:
    """Ids of Latin text under a lower-casing vocabulary with word ends, by tiktoken's merging.

    Each piece of the split pattern gets an end sign, whose merge with the last byte comes before all others, so pieces
    merge as the vocabulary's merges say. Other tokenizers and other scripts have no merger. Joins hold its ids
    against the tokenizer's own, and tests do so for whole texts.
    """

    END = "\x01"

    def __init__(self, layout: dict):
        import tiktoken

        of = _byte_of_char()
        base = {bytes([b]): b for b in range(256)} | {bytes([b, 1]): 256 + b for b in range(256) if b != 1}
        names = {bytes([b]): c for c, b in of.items()} | {bytes([b, 1]): c + "</w>" for c, b in of.items() if b != 1}
        for merge in layout["model"]["merges"]:
            name = "".join(merge.split(" ") if isinstance(merge, str) else merge)
            plain = name.removesuffix("</w>")
            token = bytes(map(of.__getitem__, plain)) + (b"\x01" if len(plain) < len(name) else b"")
            if token not in base:
                base[token] = 256 + len(base)
                names[token] = name
        vocabulary = layout["model"]["vocab"]
        size = max(base.values()) + 1
        self.id_of, self.name_of = [-1] * size, [""] * size
        for token, rank in base.items():
            if token in names:
                self.id_of[rank], self.name_of[rank] = vocabulary.get(names[token], -1), names[token]
        self.encode = tiktoken.Encoding(
            "word_ends", pat_str="[^\x01]+\x01", mergeable_ranks=base, special_tokens={}).encode_ordinary

    @staticmethod
    def fits(layout: dict) -> bool:
        kinds = [n["type"] for n in (layout.get("normalizer") or {}).get("normalizers", [])]
        split = (layout.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        return (kinds == ["NFC", "Replace", "Lowercase"] and layout["model"].get("end_of_word_suffix") == "</w>"
                and split[0].get("pattern") == {"Regex": _SPLIT} and len(split) == 2 and layout.get("decoder") is None)

    def __call__(self, text: str) -> tuple[list[int], str] | None:
        if not _LATIN.fullmatch(text):
            return None
        pieces = _LATIN_SPLIT.findall(text.lower())
        if not pieces:
            return [], ""
        ranks = self.encode(self.END.join(pieces) + self.END)
        ids = list(map(self.id_of.__getitem__, ranks))
        return (ids, " ".join(map(self.name_of.__getitem__, ranks))) if -1 not in ids else None


class Codec:
    """Encodes and decodes texts with one tokenizer file."""

    def __init__(self, path: str, chunk_bytes: int = CHUNK_BYTES, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        self.special = [t["content"] for t in layout.get("added_tokens", [])]
        #: Without a decoder, ids decode to their tokens with a space between; else a text is decoded whole.
        self.by_part = layout.get("decoder") is None
        self.merger = Merger(layout) if Merger.fits(layout) else None
        self.chunk_bytes = chunk_bytes
        self.chunks = Memory(self._merged, remembered)
        self.outer = Memory(self._merged, 4 * remembered)
        self.joins = Memory(self._both, remembered)

    def _decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def _both(self, texts: list[str]) -> list[tuple[list[int], str]]:
        """Ids and decoded text, by the tokenizer."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [(e.ids, self._decode(e.ids) if self.by_part else "") for e in found]

    def _merged(self, texts: list[str]) -> list[tuple[list[int], str]]:
        """The same, by the merger where it can."""
        if not self.merger:
            return self._both(texts)
        out = [self.merger(t) for t in texts]
        rest = iter(self._both([t for t, found in zip(texts, out) if found is None]))
        return [next(rest) if found is None else found for found in out]

    def _cut(self, text: str) -> list[str]:
        data = text.encode()
        out, begin = [], 0
        for at in gear.cuts(np.frombuffer(data, dtype=np.uint8), self.chunk_bytes).tolist():
            chunk = data[begin:at].decode()
            if len(_GAP.split(chunk)) > CHUNK_WORDS:
                out.append(chunk)
                begin = at
        last = data[begin:].decode()
        if out and len(_GAP.split(last)) <= CHUNK_WORDS:
            out[-1] += last
        else:
            out.append(last)
        return out

    def encode(self, texts: list[str]) -> list[tuple[list[int], str]]:
        """Ids and decoded text of each text."""
        parts = []
        for text in texts:
            chunks = self._cut(text)
            # Of a chunk: the half word at its start, its whole words, and the half word at its end.
            own = []
            for k, chunk in enumerate(chunks):
                left = _GAP.search(chunk).end() if k else 0
                right = _last_gap(chunk, len(chunk)) if k + 1 < len(chunks) else len(chunk)
                own.append((chunk[:left], chunk[left:right], chunk[right:]))
            parts.append(own)
        known = iter(self.chunks.of([whole for own in parts for _, whole, _ in own]))
        values = [[next(known) for _ in own] for own in parts]
        joins = iter(self._joins([(own[k - 1], own[k], got[k - 1][0], got[k][0])
                                  for own, got in zip(parts, values) for k in range(1, len(own))]))
        out = []
        for text, value in zip(texts, values):
            between = [next(joins) for _ in value[1:]]
            if None in between or any(s in text for s in self.special):
                out += self._both([text])
                continue
            pieces = [value[0]]
            for join, chunk in zip(between, value[1:]):
                pieces += [join, chunk]
            ids = [i for got, _ in pieces for i in got]
            out.append((ids, " ".join([d for got, d in pieces if got])))
        return out if self.by_part else [(ids, self._decode(ids)) for ids, _ in out]

    def _joins(self, places: list) -> list[tuple[list[int], str] | None]:
        """For each join, what stands between the ids of its two chunks; None where they never agree."""
        answers: list = [None] * len(places)
        disagree, reach = list(range(len(places))), OUTER_WORDS
        while disagree:
            asked = []
            for p in disagree:
                (_, left, half), (other, right, _), _, _ = places[p]
                before, after = _last_words(left, reach), _first_words(right, reach)
                asked.append((p, before, before + half + other + after, after))
            windows = self.joins.of([window for _, _, window, _ in asked])
            outer = iter(self.outer.of([w for _, before, _, after in asked for w in (before, after)]))
            disagree = []
            for (p, before, _, after), (ids, _) in zip(asked, windows):
                (_, left, _), (_, right, _), left_ids, right_ids = places[p]
                (a, _), (b, _) = next(outer), next(outer)
                end = len(ids) - len(b)
                if (len(a) <= end and ids[:len(a)] == a == left_ids[len(left_ids) - len(a):]
                        and ids[end:] == b == right_ids[:len(b)]):
                    answers[p] = (ids[len(a):end], self._decode(ids[len(a):end]) if self.by_part else "")
                elif (before, after) != (left, right):
                    disagree.append(p)
            reach *= 2
        return answers


def _last_gap(text: str, end: int) -> int:
    """Where the last gap before ``end`` begins, or -1."""
    at = max(text.rfind(" ", 0, end), text.rfind("\n", 0, end))
    while at > 0 and text[at - 1] in " \n":
        at -= 1
    return at


def _last_words(text: str, n: int) -> str:
    at = len(text)
    for _ in range(n):
        at = _last_gap(text, at)
        if at < 0:
            return text
    return text[at:].lstrip(" \n")


def _first_words(text: str, n: int) -> str:
    at = 0
    for _ in range(n):
        found = _GAP.search(text, at)
        if not found:
            return text
        at = found.end()
    return text[:at].rstrip(" \n")


def encode_decode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                  chunk_bytes: int = CHUNK_BYTES, digests: bool = False) -> DataFrame:
    """Ids and decoded text of every document, or with ``digests`` their SHA-256 in place of them."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if (path, chunk_bytes) not in _CODECS:
            _CODECS[path, chunk_bytes] = Codec(path, chunk_bytes)
        codec = _CODECS[path, chunk_bytes]
        for batch in batches:
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.iloc[at:at + TEXTS_AT_ONCE]
                found = codec.encode([t if isinstance(t, str) else "" for t in part.text])
                if digests:
                    yield pd.DataFrame({
                        "doc_id": part.doc_id.to_numpy(), "n_tokens": [len(ids) for ids, _ in found],
                        "ids_sha256": [hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() for ids, _ in found],
                        "decoded_sha256": [hashlib.sha256(d.encode()).hexdigest() for _, d in found]})
                else:
                    yield pd.DataFrame({"doc_id": part.doc_id.to_numpy(), "n_tokens": [len(ids) for ids, _ in found],
                                        "ids": [ids for ids, _ in found], "decoded": [d for _, d in found]})

    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInPandas(run, DIGESTS if digests else SCHEMA)


SCHEMA = "doc_id long, n_tokens long, ids array<int>, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

_CODECS: dict = {}
