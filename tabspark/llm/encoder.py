"""Encoding whole texts with a public tokenizer.

A byte-level tokenizer whose ids follow the order of its merges is run through tiktoken with its own vocabulary as ranks: the ids
are the same, at a third of the time. Its tokens are runs of bytes, so their lengths give their places in the text.
Tokenizers of other kinds encode by themselves.
"""

from __future__ import annotations

import json
import os
from array import array
from functools import cached_property, lru_cache

import numpy as np

from tabspark.llm.common import AT_END

#: Fixed value: how byte-level tokenizers split a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_letter() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Token ids, and their spans, of texts. `spec` is the tokenizer's JSON."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        rules = json.loads(spec)
        before, model, added = rules.get("pre_tokenizer") or {}, rules["model"], rules.get("added_tokens") or []
        vocabulary = model.get("vocab", {})
        most = max([t["id"] for t in added] + (list(vocabulary.values()) if isinstance(vocabulary, dict) else [len(vocabulary)]), default=0)
        self.spec, self.dtype = spec, np.dtype("<u2" if most < 1 << 16 else "<u4")
        self.byte_level = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and not rules.get("normalizer") and not rules.get("post_processor")
        self.byte_level = self.byte_level and before.get("use_regex", True) and self._ranked(model, {t["content"] for t in added})

    @cached_property
    def tokenizer(self):
        """The tokenizer itself; made only where the quick encoding won't do."""
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(self.spec)
        made.encode_special_tokens = True
        return made

    def _ranked(self, model: dict, special: set[str]) -> bool:
        """Whether ids follow the order of merges, as ranks do; if so, makes the quick encoding."""
        import tiktoken

        letters, vocabulary = byte_of_letter(), model.get("vocab", {})
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model.get("merges", [])]
        plain = {t: i for t, i in vocabulary.items() if t not in special}
        if merged != sorted(merged) or not all(c in letters for t in plain for c in t) or sum(len(t) == 1 for t in plain) != 256 or len(merged) + 256 != len(plain):
            return False
        ranks = {bytes(letters[c] for c in t): i for t, i in plain.items()}
        self.quick = tiktoken.Encoding("quick", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.widths = np.zeros(max(ranks.values()) + 1, "i8")
        for t, i in ranks.items():
            self.widths[i] = len(t)
        return True

    def _slow(self, texts: list[str]) -> list:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian integers of `dtype`; none for null and empty texts."""
        texts = [t or "" for t in texts]
        if not self.byte_level:
            return self._slow(texts)
        kind = "H" if self.dtype.itemsize == 2 else "I"
        return [array(kind, self._run(t)).tobytes() for t in texts]

    def _run(self, text: str) -> list[int]:
        """The quick encoding, or the tokenizer itself for a text that is too much for it (a run of blanks of about a million characters)."""
        try:
            return self.quick.encode_ordinary(text)
        except BaseException as e:  # a panic of the library is no Exception
            if type(e).__name__ != "PanicException":
                raise
            return self.tokenizer.encode(text, add_special_tokens=False).ids

    def located(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """First character and end of every token of each text. A token within one character has that character's span."""
        texts = [t or "" for t in texts]
        if not self.byte_level:
            spans = [np.array(e.offsets, "i8").reshape(-1, 2) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            return [(s[:, 0], s[:, 1]) for s in spans]
        out = []
        for text, ids in zip(texts, self.ids(texts)):
            ends = np.cumsum(self.widths[np.frombuffer(ids, self.dtype)])
            starts = np.append(0, ends[:-1]) if len(ends) else ends
            if not text.isascii():
                raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), "u1")
                place = np.cumsum((raw & 0xC0) != 0x80) - 1
                starts, ends = place[starts], place[ends - 1] + 1
            out.append((starts, ends))
        return out


@lru_cache(maxsize=4)
def encoder(spec: str) -> Encoder:
    """One for all batches of a task."""
    return Encoder(spec)


AT_END.append(encoder.cache_clear)
