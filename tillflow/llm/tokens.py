"""Token ids of whole texts by public tokenizers.

The ids are those of the `tokenizers` library for a byte-level BPE file. Texts
whose code points have been letters, marks or digits in every version of
Unicode that the libraries know are encoded by tiktoken over the same
vocabulary and the same split rule, which is several times faster; all others
go to `tokenizers`. tiktoken needs ids in the order of the merges, which is
checked when the file is read; if it does not hold, every text goes to
`tokenizers`.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

# How a byte-level tokenizer of this kind splits text before it merges bytes, and the
# code points that tiktoken may see (Latin, basic Cyrillic, dashes and quotes, kana, Han, Hangul).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNUSUAL = re.compile("[^\x00-ɏА-я‐-‧ぁ-ゔァ-ヺ一-龥가-힣]")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be printed,
    else the next code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


class ByteTokens:
    """Ids of a byte-level BPE file. `plain`: the strings of added tokens are ordinary text;
    otherwise a text that holds one gets that token's id, as the file says."""

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = set() if plain else self.special
        self.fast = self._same_vocabulary(path)

    def _same_vocabulary(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            read = json.load(f)
        vocab, split = read["model"]["vocab"], read["pre_tokenizer"] or {}
        merges = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in read["model"]["merges"]]
        first = len(set(vocab) - self.special) - len(merges)
        if (read["normalizer"] is not None or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
                or any(vocab[m] != first + i for i, m in enumerate(merges))):
            return None
        ranks = {b: i for i, b in enumerate(self.token_bytes()) if self.tokenizer.id_to_token(i) not in self.special}
        return tiktoken.Encoding("same", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        rest = []
        for i, t in enumerate(texts):
            if self.fast is None or UNUSUAL.search(t) or any(a in t for a in self.added):
                rest.append(i)
            else:
                out[i] = np.array(self.fast.encode_ordinary(t), "<u4")
        for i, e in zip(rest, self.tokenizer.encode_batch([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(e.ids, "<u4")
        return out

    def token_bytes(self) -> list[bytes]:
        """Bytes of each id."""
        back = {c: b for b, c in byte_letters().items()}
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        return [bytes(back[c] for c in name) if name not in self.special else name.encode() for name in names]


class PieceTokens:
    """Ids of a sentencepiece model, special tokens never taken from the text."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, "<u4") for x in self.model.encode(texts, num_threads=1)]

    def token_bytes(self) -> list[bytes]:
        m = self.model
        return [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i)
                else m.id_to_piece(i).replace("▁", " ").encode() for i in range(m.get_piece_size())]


def texts_of(column) -> list[str]:
    """An Arrow column's texts, NULL as the empty text."""
    return [t or "" for t in column.to_pylist()]
