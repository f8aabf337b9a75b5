"""Byte-level BPE ids of whole texts, word by word through a bounded memory of words already encoded.

The split pattern of a byte-level vocabulary starts a new token before a single space that stands between
two characters which are no white space, and on both sides of a lone line break between such characters. A
text may be cut there without changing its ids, and each part is encoded once while it is remembered. A text
with any other white space, or one that spells a special token, goes to the tokenizer whole.

Parts of Latin script are merged by tiktoken with the ranks of the same vocabulary, which is several times
faster on short strings; all else by tokenizers. Tests hold the ids of both against each other.
"""

import json
from collections.abc import Callable

#: Parts remembered in one task, in each of two generations.
REMEMBERED = 150_000
#: From here on (end of the Latin blocks) the two libraries' character classes may differ.
_BEYOND_LATIN = "ɐ"
#: Fixed value: how a byte-level vocabulary cuts text before merging.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Memory(dict):
    """Values of parts, computed at the first miss; two generations of at most ``size`` parts are kept."""

    def __init__(self, compute: Callable[[str], bytes], size: int = REMEMBERED):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, part: str) -> bytes:
        value = self.old.get(part)
        if value is None:
            value = self.compute(part)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[part] = value
        return value


def _byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable Latin-1 is itself, the rest follows on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Encoder:
    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        self.special = [t["content"] for t in layout.get("added_tokens", [])]
        of = _byte_of_char()
        ranks = {bytes(map(of.__getitem__, token)): rank for token, rank in layout["model"]["vocab"].items()
                 if token not in self.special}
        self.merger = tiktoken.Encoding("byte_bpe", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _ids(self, ids: list[int]) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def whole(self, text: str) -> bytes:
        return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _part(self, part: str) -> bytes:
        return self._ids(self.merger.encode_ordinary(part)) if max(part) < _BEYOND_LATIN else self.whole(part)

    def for_task(self) -> Callable[[list[str]], list[bytes]]:
        """Encodes texts with a memory that ends with the task, so it doesn't weigh on later stages."""
        spaced, bare = Memory(lambda part: self._part(" " + part)), Memory(self._part)
        return lambda texts: [self.encode(t, spaced, bare) for t in texts]

    def encode(self, text: str, spaced: Memory, bare: Memory) -> bytes:
        plain = (text and text[0] not in " \n" and text[-1] not in " \n" and "  " not in text and "\n\n" not in text
                 and " \n" not in text and "\n " not in text and not any(s in text for s in self.special)
                 and sum(map(len, text.split())) == len(text) - text.count(" ") - text.count("\n"))
        if not plain:
            return self.whole(text)
        out: list[bytes] = []
        for line in text.split("\n"):
            if out:
                out.append(bare["\n"])
            words = iter(line.split(" "))
            out.append(bare[next(words)])
            out.extend(map(spaced.__getitem__, words))
        return b"".join(out)


_ENCODERS: dict[str, _Encoder] = {}


def encoder(path: str) -> Callable[[], Callable[[list[str]], list[bytes]]]:
    """Makes, inside a task, a function from texts to ids as little-endian unsigned 32-bit bytes."""

    def make() -> Callable[[list[str]], list[bytes]]:
        if path not in _ENCODERS:
            _ENCODERS[path] = _Encoder(path)
        return _ENCODERS[path].for_task()

    return make
