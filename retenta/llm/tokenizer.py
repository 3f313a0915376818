"""Public tokenizer files in tasks: loaded once per Python worker, by path."""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_loaded: dict[str, object] = {}
_cores: dict[str, tuple[object, dict[int, str]] | None] = {}

#: Cores whose tokens are held at once.
CORES_HELD = 4096
#: What a vocabulary does to a text before its merges, if it is cut by ``CORE``.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Pieces without blanks of these characters alone, which no normal form changes, and what they are cut to in
#: lower case.
PLAIN = re.compile(r"[ -~À-ÖØ-öø-ÿ]*")
CORE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def load(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        _loaded[path] = tok
    return _loaded[path]


def dtype_of(path: str, also: int = 0) -> str:
    """The narrowest unsigned type for the vocabulary's ids and the id ``also``."""
    return "<u2" if max(load(path).get_vocab_size(), also + 1) <= 1 << 16 else "<u4"


@functools.cache
def specials(path: str) -> tuple[str, ...]:
    """Texts of the special and added tokens, longest first."""
    return tuple(sorted((t.content for t in load(path).get_added_tokens_decoder().values()), key=len, reverse=True))


def _mark(path: str) -> tuple[str, int] | None:
    """A special token that stands for itself wherever it occurs: text and id."""
    for i, token in load(path).get_added_tokens_decoder().items():
        if token.special and not (token.lstrip or token.rstrip or token.single_word or token.normalized):
            return token.content, i
    return None


def encode(path: str, texts: list[str], dtype: str) -> list[bytes]:
    """Each text's ids, packed. Many texts go through the library as one, parted by a special
    token: it cuts a text before any other rule, so the parts are encoded as if alone."""
    tok, mark = load(path), _mark(path)
    alone = [t for t in texts if mark is None or mark[0] in t]
    own = dict(zip(alone, (np.array(e.ids, dtype).tobytes() for e in tok.encode_batch_fast(alone, add_special_tokens=False)),
                   strict=True))
    rest, out = [t for t in texts if t not in own] if own else texts, []
    for at in range(0, len(rest), 1 << 12):
        ids = np.array(tok.encode_batch_fast([mark[0].join(rest[at:at + (1 << 12)])], add_special_tokens=False)[0].ids, dtype)
        ends = np.append(np.flatnonzero(ids == mark[1]), len(ids)) * ids.itemsize
        data, start = ids.tobytes(), 0
        for end in ends.tolist():
            out.append(data[start:end])
            start = end + ids.itemsize
    if not own:
        return out
    found = iter(out)
    return [own[t] if t in own else next(found) for t in texts]


def _core_model(path: str):
    """For vocabularies of the rule above: the merges without it, and how they write the bytes of letters
    outside ASCII. None for others."""
    if path not in _cores:
        from tokenizers import pre_tokenizers
        with open(path, encoding="utf-8") as f:
            rule = json.load(f)
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        written = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x100)}
        known = rule["normalizer"] == NORMALIZER and rule["pre_tokenizer"] == PRE_TOKENIZER
        _cores[path] = (load(path).model, written) if known else None
    return _cores[path]


def encode_cores(path: str, cores: list[str], dtype: str) -> list[bytes]:
    """Each core's ids, packed."""
    (model, written), out = _core_model(path), []
    for at in range(0, len(cores), CORES_HELD):
        tokens = [model.tokenize(core if core.isascii() else core.translate(written)) for core in cores[at:at + CORES_HELD]]
        ids = np.array([t.id for of_core in tokens for t in of_core], dtype)
        data, start = ids.tobytes(), 0
        for n in map(len, tokens):
            out.append(data[start:start + n * ids.itemsize])
            start += n * ids.itemsize
    return out


class WordIds(dict):
    """Ids of text pieces as packed numbers, each piece encoded when first met; emptied
    when it holds ``limit`` pieces (about 250 bytes each). A Python worker keeps one for all
    its tasks. Plain pieces are put together of their cores, which are pieces too: a word is
    encoded once in whatever case and beside whatever signs it stands."""

    _known: dict[tuple[str, str], WordIds] = {}

    def __init__(self, path: str, dtype: str, limit: int = 2_000_000):
        super().__init__()
        self.path, self.dtype, self.limit = path, dtype, limit

    @classmethod
    def of(cls, path: str, dtype: str) -> WordIds:
        return cls._known.setdefault((path, dtype), cls(path, dtype))

    def _unknown(self, pieces: Iterable[str]) -> set[str]:
        # looked up one by one: a set's difference with a dict's subclass walks the whole table
        return {p for p in pieces if p not in self}

    def learn(self, pieces: Iterable[str]) -> None:
        if len(self) > self.limit:
            self.clear()
        new = list(self._unknown(pieces))
        if _core_model(self.path):
            new = self._learn_plain(new)
        self.update(zip(new, encode(self.path, new, self.dtype), strict=True))

    def _learn_plain(self, new: list[str]) -> list[str]:
        """Learns the plain pieces and returns the others."""
        marks, joined = specials(self.path), " ".join(new)
        plain, rest = new, []
        if not PLAIN.fullmatch(joined) or any(m in joined for m in marks):
            plain = [p for p in new if PLAIN.fullmatch(p) and " " not in p and not any(m in p for m in marks)]
            rest = list({*new}.difference(plain))
        cut = [[p] if p.isalpha() else CORE.findall(p) for p in map(str.lower, plain)]
        cores = list(self._unknown(itertools.chain.from_iterable(cut)))
        self.update(zip(cores, encode_cores(self.path, cores, self.dtype), strict=True))
        # pieces of one core share its bytes
        self.update((p, self[c[0]] if len(c) == 1 else self.ids(c)) for p, c in zip(plain, cut, strict=True))
        return rest

    def ids(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, pieces))

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each text has. Pieces are told apart
        by Arrow, so that each is looked up once for all texts; new ones are learned together."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        pieces = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.get, pieces))
        if None in found:
            self.learn(p for p, ids in zip(pieces, found, strict=True) if ids is None)
            found = [self[p] if ids is None else ids for p, ids in zip(pieces, found, strict=True)]
        ids = np.frombuffer(b"".join(found), self.dtype)
        n = np.fromiter(map(len, found), np.int64, len(found)) // ids.itemsize
        word = words.indices.to_numpy()
        starts, n = (n.cumsum() - n)[word], n[word]
        ends = np.concatenate(([0], n.cumsum()))
        at = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], n)
        return ids[at], np.diff(ends[np.concatenate(([0], pc.list_value_length(lists).to_numpy().cumsum()))])
