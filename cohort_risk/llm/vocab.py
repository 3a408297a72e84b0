"""Byte-level BPE vocabulary files, and the word split that goes with them."""

from __future__ import annotations

import json
from functools import lru_cache

import regex

# The word split of the byte-level vocabularies. White space is spelled out,
# since regular expression libraries differ over a few control characters.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters and digits of later Unicode versions, which the vocabularies' library takes as signs.
NEWER = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d "
    "107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 "
    "1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff "
    "18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 "
    "1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 "
    "1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 "
    "3d000-3fc3f"
)
#: Pairs of tokens whose verdict is remembered.
JOINED_PAIRS = 300_000
_newer = "".join("-".join(rf"\U{int(c, 16):08x}" for c in r.split("-")) for r in NEWER.split())
LETTER, DIGIT = rf"[\p{{L}}--[{_newer}]]", rf"[\p{{N}}--[{_newer}]]"
SPLIT = (
    rf"(?V1) ?{LETTER}+|'s|'t|'re|'ve|'m|'ll|'d| ?{DIGIT}+"
    rf"| ?[[^{SPACE}\p{{L}}\p{{N}}][{_newer}]]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and special tokens of one vocabulary file.

    ``order`` numbers tokens by the moment they come into being: single bytes first, then
    merges by rank. ``left`` and ``right`` are the parts of a merged token in that numbering.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters, ids = byte_letters(), content["model"]["vocab"]
        raw = {token: bytes(letters[c] for c in token) for token in ids}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" "))
                  for m in content["model"]["merges"]]
        made = {a + b for a, b in merges}
        base = sorted((token for token in ids if token not in made), key=ids.get)
        order = {token: i for i, token in enumerate(base)}
        self.n_base = len(base)
        self.left, self.right = list(range(self.n_base)), list(range(self.n_base))
        self.pair: dict[tuple[int, int], int] = {}
        for a, b in merges:
            if a + b not in order:
                order[a + b] = len(self.left)
                self.left.append(order[a])
                self.right.append(order[b])
            self.pair.setdefault((order[a], order[b]), order[a + b])
        self.by_bytes = {raw[token]: i for token, i in order.items()}
        self.ids = [0] * len(order)
        for token, i in order.items():
            self.ids[i] = ids[token]
        self.packed_ids = [i.to_bytes(4, "little") for i in self.ids]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.token_bytes = {ids[token]: data for token, data in raw.items()}
        for token, i in self.special.items():
            self.token_bytes[i] = (bytes(letters[c] for c in token) if set(token) <= set(letters)
                                   else token.encode())
        self.words = regex.compile(SPLIT).findall
        names = sorted(self.special, key=len, reverse=True)
        self.special_split = (
            regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None)
        self.joined: dict[tuple[int, int], bool] = {}
        self._link_suffixes()

    def _link_suffixes(self) -> None:
        """An automaton over all tokens: its state is the longest token prefix that ends a text.

        ``ending`` is the longest token that ends it, ``shorter`` the next token that ends a token.
        """
        self.goto: dict[int, int] = {}
        depth_of, state_of = [0], [0] * len(self.ids)
        exact = {}
        for data, token in self.by_bytes.items():
            state = 0
            for byte in data:
                below = self.goto.get(state << 8 | byte)
                if below is None:
                    below = self.goto[state << 8 | byte] = len(depth_of)
                    depth_of.append(depth_of[state] + 1)
                state = below
            exact[state], state_of[token] = token, state
        self.fail = [0] * len(depth_of)
        self.ending = [exact.get(state, -1) for state in range(len(depth_of))]
        edges = sorted(self.goto.items(), key=lambda edge: depth_of[edge[1]])
        for edge, state in edges:
            above, byte = edge >> 8, edge & 255
            if above:
                self.fail[state] = self.step(self.fail[above], byte)
            if self.ending[state] < 0:
                self.ending[state] = self.ending[self.fail[state]]
        self.shorter = [self.ending[self.fail[state]] for state in state_of]
        self.size = [depth_of[state] for state in state_of]

    def step(self, state: int, byte: int) -> int:
        """The automaton's state after one more byte."""
        goto, fail = self.goto, self.fail
        while True:
            following = goto.get(state << 8 | byte)
            if following is not None:
                return following
            if not state:
                return 0
            state = fail[state]

    def stays_apart(self, first: int, second: int) -> bool:
        """Whether merging the bytes of both tokens leaves just these two.

        They are unmade in the opposite order of their merges. If two parts that touch at some
        moment would have merged before either grew further, the tokens don't stay apart.
        """
        known = self.joined.get((first, second))
        if known is None:
            if len(self.joined) >= JOINED_PAIRS:
                self.joined.clear()
            known = self.joined[first, second] = self._unmerged(first, second)
        return known

    def _unmerged(self, first: int, second: int) -> bool:
        until_first = until_second = len(self.left)
        while True:
            merged = self.pair.get((first, second))
            # of equal merges the left one comes first
            if merged is not None and merged < until_first and merged <= until_second:
                return False
            if max(first, second) < self.n_base:
                return True
            if first > second:
                until_first, first = first, self.right[first]
            else:
                until_second, second = second, self.left[second]


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    """The vocabulary of ``path``, read once per worker."""
    return Vocabulary(path)
