"""BPE as a deterministic automaton over tokens, built by successive merge gadgets.

The automaton starts with one state per base symbol and an arc for every base symbol.
The gadget of a merge ``u v -> w`` adds an arc ``w`` to every state that has an arc
``u`` leading to an arc ``v``; the state behind ``w`` is the state behind ``v`` as it is
at that moment; then the arc ``v`` leaves the state behind ``u``. The state behind an arc
therefore depends on its label alone, and after all gadgets the automaton accepts for
each string exactly one path: its BPE tokens.

Arcs of all states would fill a table of the squared vocabulary. The transition table is
therefore filled when an arc is first asked for, by replaying the gadgets that touched it:
each was applied at a known rank, so presence follows from two older arcs.
"""

from __future__ import annotations

import json

import regex
import tokenizers

START = -1


def byte_letters() -> list[str]:
    """Printable letter of each byte: itself where printable, else the next free code point."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return [letters[b] for b in range(256)]


class MergeAutomaton:
    """Token automaton of ordered merges.

    ``names``: token strings by id. ``merges``: pairs of names in rank order.
    """

    def __init__(self, names: list[str], merges: list[tuple[str, str]]):
        ids = {n: i for i, n in enumerate(names)}
        self.names = names
        self.parts: list[tuple[int, int] | None] = [None] * len(names)
        self.born = [-1] * len(names)  # rank of the gadget that made the token
        self.rank: dict[tuple[int, int], int] = {}
        self._arcs: dict[tuple[int, int], bool] = {}
        self.usable = [True] * len(names)
        for r, (a, b) in enumerate(merges):
            u, v, w = ids[a], ids[b], ids[a + b]
            self.rank.setdefault((u, v), r)
            if self.parts[w] is None:
                self.parts[w], self.born[w] = (u, v), r
                self.usable[w] = self.usable[u] and self.usable[v] and self._present(u, v, r, False)

    def _present(self, x: int, w: int, when: int, after: bool) -> bool:
        """Is arc ``w`` in the state behind ``x`` before (or just after) gadget ``when``?"""
        while True:
            gone = self.rank.get((x, w))
            if gone is not None and (gone <= when if after else gone < when):
                return False
            bx, bw = self.born[x], self.born[w]
            if bx < 0 and bw < 0:
                return True
            if bw == bx:  # one gadget made both: the older state behind v got the arc too
                x, w, when, after = self.parts[x][1], self.parts[w][0], bx, False
            elif bw > bx:  # the gadget that made w copied the arc of its left part
                w, when, after = self.parts[w][0], bw, True
            else:  # the state behind x is the older state behind its right part
                x, when, after = self.parts[x][1], bx, False

    def arc(self, state: int, label: int) -> bool:
        """Does the state behind token ``state`` have the arc ``label``?"""
        if state == START:
            return self.usable[label]
        key = (state, label)
        found = self._arcs.get(key)
        if found is None:
            if len(self._arcs) > 2_000_000:  # the table is refilled, so memory stays bounded
                self._arcs.clear()
            found = self.usable[label] and self._present(state, label, 1 << 60, True)
            self._arcs[key] = found
        return found


class WordCoder:
    """Encode and decode with an automaton whose words end in marked symbols."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, added = spec["model"], spec["added_tokens"]
        suffix = model["end_of_word_suffix"] or ""
        names = [""] * (max([*model["vocab"].values(), *(a["id"] for a in added)]) + 1)
        for name, i in model["vocab"].items():
            names[i] = name
        self.added = {a["content"]: a["id"] for a in added}
        for name, i in self.added.items():
            names[i] = name
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.names = names
        self.auto = MergeAutomaton(names, merges)
        letters = {c: b for b, c in enumerate(byte_letters())}
        # Byte trie; a node is [next nodes by byte, token inside a word, token at a word's end].
        self.root: list = [{}, None, None]
        for name, i in model["vocab"].items():
            final = bool(suffix) and name.endswith(suffix) and len(name) > len(suffix)
            node = self.root
            for c in name[: -len(suffix)] if final else name:
                node = node[0].setdefault(letters[c], [{}, None, None])
            node[2 if final else 1] = i
        if not suffix:
            raise ValueError("Only vocabularies with marked word ends are supported.")
        # The split pattern and normalisation of this kind of vocabulary.
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        # Beyond ASCII the library's own tables decide what is a letter, a number or lower case.
        self._normal = tokenizers.Tokenizer.from_str(text).normalizer
        self._split = tokenizers.pre_tokenizers.Split(tokenizers.Regex(pattern), "removed", invert=True)
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self._words: dict[bytes, tuple[int, ...]] = {}

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        """The only accepted path that spells ``word``.

        Longest arcs are tried first. A prefix has one path only, so a position that
        leads nowhere is never entered twice.
        """
        n, arc, root = len(word), self.auto.arc, self.root
        path: list[int] = []
        state, at = START, 0
        open_arcs: list[tuple[int, int, list[tuple[int, int]]]] = []
        dead: set[int] = set()
        while at < n:
            node, found = root, []
            for i in range(at, n - 1):
                node = node[0].get(word[i])
                if node is None:
                    break
                if node[1] is not None:
                    found.append((node[1], i + 1))
            else:
                node = node[0].get(word[n - 1])
                if node is not None and node[2] is not None:
                    found.append((node[2], n))
            open_arcs.append((state, at, found))
            while True:
                if not open_arcs:
                    raise ValueError("No path spells the word: a base symbol is missing.")
                state, at, found = open_arcs[-1]
                while found:
                    label, end = found.pop()
                    if end not in dead and arc(state, label):
                        break
                else:
                    dead.add(at)
                    open_arcs.pop()
                    if path:
                        path.pop()
                    continue
                path.append(label)
                state, at = label, end
                break
        return tuple(path)

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a text without white space, or of any text: white space is dropped."""
        out: list[int] = []
        at = 0
        for m in self._special.finditer(chunk):
            out += self._plain(chunk[at : m.start()])
            out.append(self.added[m.group()])
            at = m.end()
        return out + self._plain(chunk[at:])

    def _plain(self, text: str) -> list[int]:
        if not text:
            return []
        if text.isascii():
            pieces = self._pieces.findall(text.lower())
        else:
            pieces = [piece for piece, _ in self._split.pre_tokenize_str(self._normal.normalize_str(text))]
        out: list[int] = []
        for piece in pieces:
            word = piece.encode()
            ids = self._words.get(word)
            if ids is None:
                ids = self.encode_word(word)
                if len(word) <= 64:
                    if len(self._words) >= 200_000:
                        self._words.clear()
                    self._words[word] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """Arc labels in path order, parted by spaces: the library's result without a decoder."""
        return " ".join(self.names[i] for i in ids)
