"""Licence scan: matching statistics of texts against a suffix automaton of licence words, chained into covered spans.

One suffix automaton holds every run of words of every template. It reads a text word by word and tells at
each word how long the longest run ending there is that some template has (its matching statistic), so no
template is tried on its own and time does not grow with their number. Words no template has reset it, so only
runs of known words are read; all runs of a slice advance together, one word a step. Runs longer than
``PIECE`` words are cut into pieces that start a longest template earlier, where the statistic is whole again.

A template's own statistic follows from the state: the longest of its suffixes that the template has. Where it
stops growing a match ends. Matches of ``LEAST_MATCH`` words or more are chained per template while they go
forward in the template and at most ``GAP`` words of text lie between them; a chain that covers ``COVER`` of its
template's words is a span and gives its label. Phrases are templates found only whole: their places are where
the automaton's state has the phrase as a suffix of what it matched.

Words are runs of letters, digits and characters beyond ASCII, A-Z read as a-z; they are compared as 64-bit
hashes. Nothing is shuffled: every text is read once, whole.

Defined cases: a null or empty text has no words, no labels and a score of 0; repeated rows give a row each;
other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hazlake.llm.licence_texts import PHRASES, TEMPLATES
from hazlake.llm.words import ALPHANUMERIC, slices, word_hashes

LEAST_MATCH = 4
GAP = 16
COVER = 0.75
PIECE = 4096
SOME = 1 << 16

Texts = tuple[tuple[str, str], ...]


class Automaton:
    """Suffix automaton of several sequences of small integers."""

    def __init__(self, sequences: list[list[int]], n_symbols: int):
        self.n_symbols = n_symbols
        edges: list[dict[int, int]] = [{}]
        link, size = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]

        def split(p: int, symbol: int) -> int:
            """The state of p's longest word followed by ``symbol``, made by a copy where it shares one with longer words."""
            q = edges[p][symbol]
            if size[q] == size[p] + 1:
                return q
            edges.append(dict(edges[q])), link.append(link[q]), size.append(size[p] + 1), ends.append([])
            copy = len(size) - 1
            link[q] = copy
            while p >= 0 and edges[p].get(symbol) == q:
                edges[p][symbol] = copy
                p = link[p]
            return copy

        for number, sequence in enumerate(sequences):
            last = 0
            for place, symbol in enumerate(sequence):
                if symbol in edges[last]:
                    last = split(last, symbol)
                else:
                    edges.append({}), link.append(0), size.append(size[last] + 1), ends.append([])
                    new, p = len(size) - 1, last
                    while p >= 0 and symbol not in edges[p]:
                        edges[p][symbol] = new
                        p = link[p]
                    if p >= 0:
                        link[new] = split(p, symbol)
                    last = new
                ends[last].append((number, place + 1))
        pairs = sorted((state * n_symbols + symbol, to) for state, out in enumerate(edges) for symbol, to in out.items())
        self.keys = np.array([k for k, _ in pairs], dtype=np.int64)
        self.targets = np.array([t for _, t in pairs], dtype=np.int32)
        self.link, self.size = np.array(link, dtype=np.int32), np.array(size, dtype=np.int32)
        # A state's words end wherever those of the states that link to it do; longest states first.
        for state in sorted(range(1, len(size)), key=lambda s: -size[s]):
            if link[state] > 0:
                ends[link[state]] += ends[state]
        #: By state: (sequence, place after it) of its words.
        self.ends = [sorted(e) for e in ends]

    def state_of(self, sequence: list[int]) -> int:
        state = 0
        for symbol in sequence:
            state = int(self.targets[np.searchsorted(self.keys, state * self.n_symbols + symbol)])
        return state

    def step(self, state: np.ndarray, length: np.ndarray, symbol: np.ndarray) -> None:
        """Read one symbol for every (state, match length), in place."""
        left = np.arange(len(state))
        while len(left):
            key = state[left].astype(np.int64) * self.n_symbols + symbol[left]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            state[left[hit]] = self.targets[at[hit]]
            length[left[hit]] += 1
            left = left[~hit]
            at_root = state[left] == 0
            length[left[at_root]] = 0
            left = left[~at_root]
            state[left] = self.link[state[left]]
            length[left] = self.size[state[left]]

    def statistics(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, warm: int) -> tuple[np.ndarray, np.ndarray]:
        """(state, match length) after every symbol of the runs start..end; 0 outside them."""
        states, lengths = np.zeros(len(symbols), dtype=np.int32), np.zeros(len(symbols), dtype=np.int32)
        # (first symbol read, first kept, end) of pieces; what a piece reads before its first kept symbol is a run-up.
        n = -(-(ends - starts) // PIECE)
        number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        run_start, run_end = np.repeat(starts, n), np.repeat(ends, n)
        kept = run_start + number * PIECE
        begin, end = np.maximum(run_start, kept - warm), np.minimum(kept + PIECE, run_end)
        order = np.argsort(begin - end, kind="stable")
        begin, kept, end = begin[order], kept[order], end[order]
        state, length = np.zeros(len(begin), dtype=np.int32), np.zeros(len(begin), dtype=np.int32)
        sizes = end - begin
        for k in range(int(sizes[0]) if len(sizes) else 0):
            active = int(np.searchsorted(-sizes, -k, side="left"))
            at = begin[:active] + k
            self.step(state[:active], length[:active], symbols[at])
            keep = at >= kept[:active]
            states[at[keep]], lengths[at[keep]] = state[:active][keep], length[:active][keep]
        return states, lengths


class Scanner:
    """The automaton of phrases and templates, and what it finds in texts."""

    def __init__(self, phrases: Texts, templates: Texts):
        labels = [label for label, _ in (*phrases, *templates)]
        hashes, at = word_hashes(pa.array([text for _, text in (*phrases, *templates)], pa.large_string()), ALPHANUMERIC)
        self.words, codes = np.unique(hashes, return_inverse=True)
        sequences = [codes[at[i] : at[i + 1]].tolist() for i in range(len(labels))]
        self.labels, self.sizes = labels, np.diff(at)
        self.longest = int(self.sizes.max())
        self.automaton = Automaton(sequences, len(self.words))
        self.n_phrases = len(phrases)
        #: By template: the shortest match that counts; a template shorter than others' counts whole.
        self.least = np.minimum(LEAST_MATCH, self.sizes[len(phrases) :])
        #: For every phrase: the states whose longest word ends with it.
        self.has = np.zeros((len(phrases), len(self.automaton.size)), dtype=bool)
        by_size = np.argsort(self.automaton.size, kind="stable").tolist()
        for k in range(len(phrases)):
            self.has[k, self.automaton.state_of(sequences[k])] = True
            for state in by_size[1:]:
                self.has[k, state] |= self.has[k, self.automaton.link[state]]
        #: By state and template: the state on its way to the root whose words the template has, and how long they are at most.
        shape = len(by_size), len(templates)
        self.holder, self.reach = np.zeros(shape, dtype=np.int32), np.zeros(shape, dtype=np.int32)
        for state in by_size[1:]:
            above = self.automaton.link[state]
            self.holder[state] = self.holder[above]
            self.reach[state] = np.minimum(self.reach[above], self.automaton.size[above])
            own = [t - len(phrases) for t in {t for t, _ in self.automaton.ends[state]} if t >= len(phrases)]
            self.holder[state, own], self.reach[state, own] = state, self.automaton.size[state]

    def _symbols(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of every word, -1 where no template has it; offsets by text)."""
        hashes, by_text = word_hashes(texts, ALPHANUMERIC)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1).astype(np.int64), by_text

    def scan(self, texts: pa.Array) -> Iterator[tuple[int, list[tuple[int, int]], list[tuple[int, int, int, int]]]]:
        """For every text: (words, [(phrase, first word)], spans as in ``_spans``)."""
        symbols, by_text = self._symbols(texts)
        known = symbols >= 0
        begins, stops = known.copy(), known.copy()
        begins[1:] &= ~known[:-1]
        stops[:-1] &= ~known[1:]
        cut = by_text[1:-1]
        cut = cut[(cut > 0) & (cut < len(known))]
        begins[cut], stops[cut - 1] = known[cut], known[cut - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        # Shorter runs hold neither a phrase nor a match.
        long = ends - starts >= min([*self.sizes[: self.n_phrases].tolist(), *self.least.tolist()])
        states, lengths = self.automaton.statistics(symbols, starts[long], ends[long], self.longest)
        places: dict[int, list[tuple[int, int]]] = {}
        for k in range(self.n_phrases):
            size = int(self.sizes[k])
            last = np.flatnonzero((lengths >= size) & self.has[k][states])
            for text, first in zip((np.searchsorted(by_text, last, side="right") - 1).tolist(), (last - size + 1).tolist()):
                places.setdefault(text, []).append((k, first - int(by_text[text])))
        matches = self._matches(states, lengths, by_text)
        for i in range(len(texts)):
            yield int(by_text[i + 1] - by_text[i]), sorted(places.get(i, [])), self._spans(matches.get(i, []))

    def _matches(self, states: np.ndarray, lengths: np.ndarray, by_text: np.ndarray) -> dict[int, list[tuple[int, int, int, int]]]:
        """By text: (start, end, template, state that has it) of every run of a template that the text's next word does not go on with."""
        at = np.flatnonzero(lengths >= self.least.min(initial=LEAST_MATCH))
        out: dict[int, list[tuple[int, int, int, int]]] = {}
        for first in range(0, len(at), SOME):
            some = at[first : first + SOME]
            text = np.searchsorted(by_text, some, side="right") - 1
            own = self._own_lengths(states[some], lengths[some])
            after = np.minimum(some + 1, len(lengths) - 1)
            goes_on = (some + 1 < by_text[text + 1])[:, None] & (self._own_lengths(states[after], lengths[after]) == own + 1)
            which, template = np.nonzero((own >= self.least) & ~goes_on)
            ends = some[which] + 1 - by_text[text[which]]
            starts = ends - own[which, template]
            holders = self.holder[states[some[which]], template]
            for t, *match in zip(text[which].tolist(), starts.tolist(), ends.tolist(), (template + self.n_phrases).tolist(), holders.tolist()):
                out.setdefault(t, []).append(tuple(match))
        return out

    def _own_lengths(self, states: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Matching statistic of every template at (state, match length)."""
        return np.minimum(self.reach[states], lengths[:, None])

    @lru_cache(maxsize=1 << 16)
    def _places(self, template: int, state: int) -> list[int]:
        return [place for t, place in self.automaton.ends[state] if t == template]

    def _spans(self, matches: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """(template, first word, end, words covered) of every chain, from matches in the order of their ends."""
        chains, last = [], {}
        for start, end, template, state in matches:
            places, chain = self._places(template, state), last.get(template)
            if chain is not None and start - chain[1] <= GAP:
                # Where the match overlaps the one before, in the text or in the template, only its rest is new.
                place = next((p for p in places if p > chain[3]), None)
                if place is not None:
                    chain[1:] = end, chain[2] + min(end - start, end - chain[1], place - chain[3]), place
                    continue
                if end - start < chain[2]:
                    continue
            if chain is not None:
                chains.append((template, *chain[:3]))
            last[template] = [start, end, end - start, places[0]]
        return sorted(chains + [(t, *c[:3]) for t, c in last.items()])


@lru_cache(maxsize=4)
def scanner(phrases: Texts, templates: Texts) -> Scanner:
    """One scanner a worker for the same texts."""
    return Scanner(phrases, templates)


_FIELDS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label: string, template: int, first_word: long, end_word: long, covered: double>>"
)


def _row(found: Scanner, n_words: int, places: list, chains: list) -> dict:
    own = {found.labels[k] for k, _ in places}
    spans = [
        {"label": found.labels[t], "template": t - found.n_phrases, "first_word": first, "end_word": end, "covered": covered / int(found.sizes[t])}
        for t, first, end, covered in chains
    ]
    whole = [s for s in spans if s["covered"] >= COVER]
    starts = [first for _, first in places]
    return {
        "n_words": n_words, "n_base": len(places), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(own)), "labels": ",".join(sorted(own | {s["label"] for s in whole})),
        # A phrase is a template that is covered whole.
        "score": 1.0 if own else max((s["covered"] for s in spans), default=0.0), "spans": whole,
    }


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, text: str = "text") -> DataFrame:
    """Per row: doc_id, words, places and labels of phrases, all labels, the best covered share and the spans found."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_FIELDS}"
    known = tuple(map(tuple, phrases)), tuple(map(tuple, templates))

    def rows(batches):
        found = scanner(*known)
        kind = None
        for batch in batches:
            out = []
            for _, some in slices(batch.column(1)):
                out += [_row(found, *r) for r in found.scan(some)]
            kind = kind or pa.struct([(f.name, f.type) for f in _arrow()])
            body = pa.array(out, kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), *body.flatten()], ["doc_id", *(f.name for f in _arrow())])

    return docs.selectExpr("doc_id", f"CAST(`{text}` AS STRING) AS text").mapInArrow(rows, schema)


def _arrow() -> list[pa.Field]:
    span = pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("covered", pa.float64())])
    longs = [pa.field(name, pa.int64()) for name in ("n_words", "n_base", "first_word", "last_word")]
    return longs + [pa.field("base_labels", pa.string()), pa.field("labels", pa.string()), pa.field("score", pa.float64()), pa.field("spans", pa.list_(span))]
