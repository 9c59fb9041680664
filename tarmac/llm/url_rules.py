"""URL filter: all glob rules at once, as a bit-parallel automaton.

Every rule is a glob over `.host` followed by the path: `*` is any run without `/`, `**`
any run, `?` one character other than `/`.  A rule with m elements has m + 1 states; the
states of all rules are packed side by side into 64-bit words.  One character moves the
states of all rules at once: literals by an and and a shift, runs by staying, and the
state behind a run is entered with it.  URLs are simulated side by side in blocks of
bounded size, so memory follows neither the number of URLs nor their length.

Host rules (`net/`, `example.com/de/`) fit the host and its subdomains when the path
starts with theirs; the longest wins.  URLs that none of them fits are judged by the
path globs, and allowed when none fits.

Defined results: a null URL, or one without `://`, has empty host and path; a URL without
a path fits no rule, since every rule has one; characters beyond ASCII match wildcards
only; repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: The host rules.
HOST_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
#: Own path globs, for URLs without a host rule; case does not matter.
PATH_GLOBS = [
    "**/ads/**", "**/adserver/**", "**/banner/**", "**/banners/**", "**/beacon/**", "**/cart/**",
    "**/cgi-bin/**", "**/checkout/**", "**/click/**", "**/clicktrack/**", "**/doubleclick/**",
    "**/login/**", "**/logout/**", "**/popup/**", "**/popunder/**", "**/signin/**", "**/signup/**",
    "**/sponsored/**", "**/track/**", "**/tracking/**", "**/wp-admin/**", "**/wp-login.php**",
    "**.exe", "**.gif", "**.ico", "**.jpeg", "**.jpg", "**.mp3", "**.mp4", "**.png", "**.svg", "**.zip",
    "*ads.*/**", "*.ad.*/**", "*.ads.*/**", "*.adserver.*/**", "*.doubleclick.*/**", "*.tracker.*/**",
]
CELLS = 1 << 21
OTHER = 128  # every code point beyond ASCII


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case (A-Z) and path; both empty without `://`."""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return re.sub("[A-Z]+", lambda x: x[0].lower(), m[1]), m[2]


class GlobAutomaton:
    """Globs as states packed into 64-bit words."""

    def __init__(self, globs: list[tuple[str, bool]]) -> None:
        """globs: pattern, and whether case matters."""
        parsed = [(re.findall(r"\*\*|.", g, re.S), case) for g, case in globs]
        bits = sum(len(e) + 1 for e, _ in parsed)
        self.words = (bits + 63) // 64
        zeros = lambda *shape: np.zeros((*shape, self.words), np.uint64)
        self.move, self.stay = zeros(OTHER + 1), zeros(OTHER + 1)
        self.start, self.run, self.final = zeros(), zeros(), zeros(len(globs))
        at = 0
        for k, (elements, case) in enumerate(parsed):
            self._set(self.start, at)
            for e in elements:
                if e in ("*", "**"):
                    self._set(self.run, at)
                    for c in range(OTHER + 1):
                        if e == "**" or c != ord("/"):
                            self._set(self.stay[c], at)
                elif e == "?":
                    for c in range(OTHER + 1):
                        if c != ord("/"):
                            self._set(self.move[c], at)
                else:
                    for c in {e} if case else {e.lower(), e.upper()}:
                        self._set(self.move[min(ord(c), OTHER)], at)
                at += 1
            self._set(self.final[k], at)
            at += 1
        self.start = self._enter(self.start[None])[0]

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit >> 6] |= np.uint64(1 << (bit & 63))

    @staticmethod
    def _shift(x: np.ndarray) -> np.ndarray:
        out = x << np.uint64(1)
        out[:, 1:] |= x[:, :-1] >> np.uint64(63)
        return out

    def _enter(self, x: np.ndarray) -> np.ndarray:
        """A run may be empty: the state behind it holds too."""
        return x | self._shift(x & self.run)

    def match(self, texts: list[str]) -> np.ndarray:
        """Which globs fit each whole text: booleans, texts by globs."""
        out = np.zeros((len(texts), len(self.final)), bool)
        order = np.argsort([len(t) for t in texts], kind="stable")
        at = 0
        while at < len(order):
            # a block: as many texts as fit, of about one length
            width = max(1, len(texts[order[at]]))
            end = at + 1
            while end < len(order) and (end + 1 - at) * max(self.words, len(texts[order[end]])) <= CELLS and len(texts[order[end]]) <= 2 * width + 64:
                end += 1
            rows = order[at:end]
            out[rows] = self._block([texts[i] for i in rows])
            at = end
        return out

    def _block(self, texts: list[str]) -> np.ndarray:
        sizes = np.array([len(t) for t in texts])
        codes = np.full((len(texts), int(sizes.max(initial=0))), OTHER, np.uint8)
        for i, t in enumerate(texts):
            codes[i, : len(t)] = np.minimum(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32), OTHER)
        state = np.repeat(self.start[None], len(texts), 0)
        for p in range(codes.shape[1]):
            live = int(np.searchsorted(sizes, p, "right"))  # shorter texts have ended
            c, x = codes[live:, p], state[live:]
            state[live:] = self._enter(self._shift(x & self.move[c]) | (x & self.stay[c]))
        return (state[:, None, :] & self.final[None]).any(2)


def judge_urls(
    pages: DataFrame, host_rules: list[tuple[str, str]] = HOST_RULES, path_globs: list[str] = PATH_GLOBS,
) -> DataFrame:
    """page_id, host, path, rule, verdict and the path glob that decided, per row of `pages`."""
    globs = [(f"*.{rule}**", True) for rule, _ in host_rules] + [(g, False) for g in path_globs]

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton, n = GlobAutomaton(globs), len(host_rules)
        by_length = sorted(range(n), key=lambda k: -len(host_rules[k][0]))
        for batch in batches:
            parts = [split_url(u) for u in batch["url"]]
            fits = automaton.match([f".{h}{p}" for h, p in parts])
            rule, verdict, glob = [], [], []
            for row in fits:
                k = next((k for k in by_length if row[k]), None)
                g = next((path_globs[j] for j in np.flatnonzero(row[n:])), None) if k is None else None
                rule.append(None if k is None else host_rules[k][0])
                glob.append(g)
                verdict.append(host_rules[k][1] if k is not None else "block" if g else "allow")
            yield pd.DataFrame({
                "page_id": batch["page_id"], "host": [h for h, _ in parts], "path": [p for _, p in parts],
                "rule": pd.Series(rule, dtype=object), "verdict": verdict, "path_glob": pd.Series(glob, dtype=object),
            })

    return pages.select("page_id", "url").mapInPandas(
        judged, "page_id bigint, host string, path string, rule string, verdict string, path_glob string")
