"""Token ids of whole texts with a public vocabulary of the tokenizers library.

Where the vocabulary is byte-level BPE whose ids ascend in the order of its
merges, the tiktoken library finds the same ids from the entries as ranks, several
times as fast (tests compare the two); it knows no added tokens, so a text that
holds one goes to the tokenizers library. So does every text of another
vocabulary."""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator

import public_tokenizers

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Characters that the regex package's Unicode tables have as letters or numbers
#: and those of the tokenizers and tiktoken libraries don't, as runs of code points
#: (fixed values, checked by a test).
NEWER = """
    558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959
    10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8
    16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128
    1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed
    1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"""


def newer_characters() -> list[int]:
    """The code points of NEWER."""
    out = []
    for run in NEWER.split():
        first, _, last = run.partition("-")
        out += range(int(first, 16), int(last or first, 16) + 1)
    return out


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: printable
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def byte_entries(vocabulary: dict[str, int]) -> dict[bytes, int] | None:
    """The entries of a byte-level vocabulary as bytes; None for another kind."""
    of = {letter: b for b, letter in byte_letters().items()}
    try:
        return {bytes(of[c] for c in entry): k for entry, k in vocabulary.items()}
    except KeyError:
        return None


def _ranks(vocabulary: str) -> dict[bytes, int] | None:
    """The entries as ranks, if ids ascend with the merges and only the usual
    byte-level split precedes them."""
    with open(vocabulary, encoding="utf-8") as f:
        model = json.load(f)
    bpe, before = model.get("model", {}), model.get("pre_tokenizer") or {}
    if bpe.get("type") != "BPE" or before.get("type") != "ByteLevel" or model.get("normalizer") or before.get("add_prefix_space"):
        return None
    added = {t["content"] for t in model.get("added_tokens", [])}
    entries = byte_entries({x: k for x, k in bpe["vocab"].items() if x not in added})
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in bpe["merges"]]
    ids = [bpe["vocab"][x] for x in merged]
    single = sum(len(x) == 1 for x in entries or {})
    ascending = single == 256 and ids == sorted(set(ids)) and len(ids) + 256 == len(entries)
    return entries if ascending else None


class Encoder:
    """Ids of texts; ``plain_added`` takes added tokens' strings as plain text."""

    def __init__(self, vocabulary: str = VOCABULARY, plain_added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = plain_added
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added if not (plain_added and t.special)]
        self.ranks = _ranks(vocabulary)
        self.fast = self.ranks and tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast and not any(t in text for t in self.added):
            return self.fast.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> bytes:
        """Ids of one text as little-endian unsigned 32-bit integers; null is empty."""
        return array("I", self.ids(text)).tobytes() if text else b""


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(vocabulary: str = VOCABULARY, plain_added: bool = False) -> Encoder:
    """The worker's encoder, made once."""
    key = vocabulary, plain_added
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def encoded(texts: list[str | None], vocabulary: str = VOCABULARY) -> Iterator[bytes]:
    return map(encoder(vocabulary).encode, texts)
