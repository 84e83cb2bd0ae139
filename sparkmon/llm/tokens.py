"""Token ids of whole texts by a public tokenizer's vocabulary, merged by rank.

The ids of both vocabularies are in the order of their merges, so merging the pair with the lowest id gives the
ids of the tokenizer file, without its cost per piece. Texts for which that isn't sure (special tokens, or
characters that the splitting here does not know) are encoded by the tokenizer itself.
"""

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


# Fixed value: the pattern by which byte-level vocabularies of this kind split a text.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_level_codes() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary."""
    # Printable bytes stand for themselves, the others for characters from 256 on in ascending order.
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + place): b for place, b in enumerate(hidden)}


class ByteLevel:
    """Encodes texts by a byte-level vocabulary, whose ids are in the order of its merges.

    Merging by rank needs no memory of pieces and gives the ids of the tokenizer file. Texts that may hold a
    special token go to the tokenizer itself, unless such tokens are to be plain text.
    """

    def __init__(self, path: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        codes = byte_level_codes()
        special = {added.content for added in self.tokenizer.get_added_tokens_decoder().values()}
        self.bytes_of = {
            i: bytes(map(codes.__getitem__, token))
            for token, i in self.tokenizer.get_vocab().items()
            if token not in special
        }
        self.ranks = Encoding(
            path,
            pat_str=BYTE_LEVEL_PATTERN,
            mergeable_ranks={held: i for i, held in self.bytes_of.items()},
            special_tokens={},
        )

    def plain_ids(self, text: str) -> list[int]:
        """Ids of a text in which special tokens are plain text."""
        return self.ranks.encode_ordinary(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return [
            np.array(
                self.tokenizer.encode(text, add_special_tokens=False).ids
                if "<|" in text
                else self.plain_ids(text),
                "<u4",
            ).tobytes()
            for text in texts
        ]


# Fixed value: what the word vocabulary splits off beside runs of letters, within the characters of SURE.
WORD_SPLIT = r"('(?:s|t|re|ve|m|ll|d)|[!-/:-@\[-`{-~\x{D7}\x{F7}]+|[0-9])|[\t-\r]"
# ASCII but control characters, and composed Latin letters whose lower case is one letter too.
UNSURE = re.compile("[^\x09-\x0d\x20-\x7e\xc0-\u012f\u0131-\u024f]")
WORD_END = "</w>"


class WordEnds:
    """Encodes texts by a lower-case vocabulary that marks ends of words and drops white space.

    A space stands for the mark: no word holds one, and a byte with the mark behind it has a lower id than any
    merge. So texts need only be split in words with one space behind each, which Arrow does for a group of
    texts at once.
    """

    def __init__(self, path: str, mark: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        codes = byte_level_codes()
        special = {added.content for added in self.tokenizer.get_added_tokens_decoder().values()}
        ranks = {}
        for token, i in self.tokenizer.get_vocab().items():
            if token not in special:
                word = token.removesuffix(WORD_END)
                ranks[bytes(map(codes.__getitem__, word)) + b" " * (word != token)] = i
        self.opening = mark[:2]
        self.ranks = Encoding(path, pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, for a group of texts of bounded size."""
        sure = [self.opening not in text and UNSURE.search(text) is None for text in texts]
        lowered = pa.array(
            [text.lower() + " " if plain else None for text, plain in zip(texts, sure, strict=True)],
            pa.large_string(),
        )
        # Words end at white space, at what is split off, or with the text.
        words = pc.replace_substring_regex(lowered, WORD_SPLIT, r" \1 ").to_pylist()
        return [
            np.array(
                self.tokenizer.encode(text, add_special_tokens=False).ids
                if split is None
                else self.ranks.encode_ordinary(split),
                "<u4",
            ).tobytes()
            for text, split in zip(texts, words, strict=True)
        ]


_ENCODERS: dict[tuple[str, str, bool], WordEnds | ByteLevel] = {}


def encoder(path: str, mark: str, spaced: bool) -> WordEnds | ByteLevel:
    """One encoder per Python worker.

    ``mark`` is a special token, all of which begin alike; ``spaced`` says whether white space belongs to the
    piece behind it.
    """
    key = (path, mark, spaced)
    if key not in _ENCODERS:
        _ENCODERS[key] = ByteLevel(path) if spaced else WordEnds(path, mark)
    return _ENCODERS[key]
