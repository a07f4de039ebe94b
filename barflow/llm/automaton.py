"""A suffix automaton over words, grown by one sequence after another."""

from __future__ import annotations

from collections.abc import Hashable, Iterator, Sequence


class SuffixAutomaton:
    """Recognises every run of consecutive words of the sequences added so far."""

    def __init__(self) -> None:
        self.length = [0]
        self.link = [-1]
        self.step: list[dict[Hashable, int]] = [{}]

    def _state(self, length: int, link: int, step: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        return len(self.length) - 1

    def _split(self, at: int, word: Hashable, target: int) -> int:
        """The state for exactly the words that reach ``target`` from ``at`` on."""
        if self.length[at] + 1 == self.length[target]:
            return target
        twin = self._state(self.length[at] + 1, self.link[target], dict(self.step[target]))
        self.link[target] = twin
        while at >= 0 and self.step[at].get(word) == target:
            self.step[at][word] = twin
            at = self.link[at]
        return twin

    def add(self, words: Sequence[Hashable]) -> None:
        last = 0
        for word in words:
            known = self.step[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
                continue
            new, at = self._state(self.length[last] + 1, 0, {}), last
            while at >= 0 and word not in self.step[at]:
                self.step[at][word] = new
                at = self.link[at]
            if at >= 0:
                self.link[new] = self._split(at, word, self.step[at][word])
            last = new

    def matching(self, words: Sequence[Hashable]) -> Iterator[int]:
        """Matching statistics: after each word, how many of the last words occur together."""
        step, link, length = self.step, self.link, self.length
        at = held = 0
        for word in words:
            while at and word not in step[at]:
                at = link[at]
                held = length[at]
            target = step[at].get(word)
            if target is None:
                held = 0
            else:
                at, held = target, held + 1
            yield held
