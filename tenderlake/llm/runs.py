"""Texts in runs that no pretoken of a byte-level vocabulary crosses, and a memory of what runs become, bounded in bytes."""

from collections.abc import Callable, Iterator

import regex

PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
BORDER = regex.compile(r"(?<=\S) (?=\S)")  #: a pretoken begins at such a space


def pretokens(run: str) -> list[str]:
    word = run[1:] if run[:1] == " " else run
    return [run] if word.isalpha() else PATTERN.findall(run)


def blocks(text: str, most: int = 1 << 20) -> Iterator[str]:
    """A long text in parts of about ``most`` characters, cut where a pretoken begins; one without such a place is one part."""
    at = 0
    while len(text) - at > most and (cut := BORDER.search(text, at + most)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Memory(dict):
    """What ``make`` returns for a run, with the size it gives as (value, bytes).

    The sizes held sum to ``most`` bytes; beyond that all is forgotten and made
    again when asked for. Runs of more than ``longest`` characters are never held.
    """

    OWN = 200  #: bytes of an entry besides its text and value

    def __init__(self, make: Callable, most: int, longest: int = 1024):
        super().__init__()
        self.make, self.most, self.longest, self.held = make, most, longest, 0

    def __missing__(self, run: str):
        value, size = self.make(run)
        if len(run) <= self.longest:
            size += 2 * len(run) + self.OWN
            if self.held + size > self.most:
                self.clear()
                self.held = 0
            self.held += size
            self[run] = value
        return value


class Runs:
    """What the runs of texts become: ``make`` gives (value, bytes) of a run."""

    def __init__(self, make: Callable, special: list[str], memory: int):
        self.special = special
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.known = Memory(make, memory // 4)
        self.spaced = Memory(lambda word: make(" " + word), memory - memory // 4)  #: words behind a space, by themselves

    def of(self, text: str) -> list:
        """Values of all runs of a text, in order."""
        if any(map(text.__contains__, self.special)):
            parts = self.splitter.split(text)
            return [x for i, p in enumerate(parts) for x in (self.plain(p) if i % 2 == 0 else [self.known[p]])]
        return self.plain(text)

    def plain_parts(self, parts: list[str]) -> list:
        """Values of single pretokens."""
        return [self.spaced[p[1:]] if p[0] == " " and len(p) > 1 else self.known[p] for p in parts]

    def plain(self, text: str) -> list:
        """Single spaces and line feeds between printable characters part words; other texts are cut by the pattern."""
        if not text:
            return []
        odd = "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[0] in " \n" or text[-1] in " \n"
        lines = [] if odd else text.split("\n")
        if odd or not all(map(str.isprintable, lines)):
            return [*map(self.known.__getitem__, PATTERN.findall(text))]
        out, first, others, feed = [], self.known.__getitem__, self.spaced.__getitem__, self.known["\n"] if len(lines) > 1 else None
        for line in lines:
            words = line.split(" ")
            out.append(feed)
            out.append(first(words[0]))
            out.extend(map(others, words[1:]))
        return out[1:]
