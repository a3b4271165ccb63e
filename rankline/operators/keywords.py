"""Ordered keyword rules over many titles: one walk of an automaton per distinct title.

A rule holds if the title contains a word of each of its groups and none of its absent words; the first rule of a list that holds gives the
result. The words of all lists make one automaton (a trie whose nodes know the longest other word beginning they end with), so
a title is read once, however many rules there are, and only rules of which a word was found are looked at.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dictionary import Group, by_distinct


@dataclass(frozen=True)
class Rule:
    result: str
    groups: tuple[tuple[str, ...], ...]
    absent: tuple[str, ...] = ()


def rules_of(triples) -> list[Rule]:
    """Rules of (result, words of which one must occur, words that must not)."""
    return [Rule(result, (tuple(words),), tuple(absent)) for result, words, absent in triples]


class Automaton:
    """Finds all words of a list that a text contains, in one walk over its characters."""

    def __init__(self, words: Sequence[str]):
        self.after: list[dict[str, int]] = [{}]
        self.ends: list[frozenset[int]] = [frozenset()]
        for number, word in enumerate(words):
            node = 0
            for c in word:
                if c not in self.after[node]:
                    self.after[node][c] = len(self.after)
                    self.after.append({})
                    self.ends.append(frozenset())
                node = self.after[node][c]
            self.ends[node] |= {number}
        self.fall = [0] * len(self.after)
        waiting = deque(self.after[0].values())
        while waiting:
            node = waiting.popleft()
            for c, child in self.after[node].items():
                self.fall[child] = self._step(self.fall[node], c)
                self.ends[child] |= self.ends[self.fall[child]]
                waiting.append(child)

    def _step(self, node: int, c: str) -> int:
        while node and c not in self.after[node]:
            node = self.fall[node]
        return self.after[node].get(c, 0)

    def found(self, text: str) -> set[int]:
        node, out = 0, set(self.ends[0])
        for c in text:
            node = self._step(node, c)
            if self.ends[node]:
                out |= self.ends[node]
        return out


class RuleBook:
    """Several named lists of ordered rules over one automaton."""

    def __init__(self, lists: Mapping[str, Sequence[Rule]]):
        self.names = list(lists)
        number: dict[str, int] = {}
        code = lambda words: frozenset(number.setdefault(w, len(number)) for w in words)
        self.lists, self.always, self.by_word = [], [], []
        for rules in lists.values():
            coded = [(r.result, [code(g) for g in r.groups], code(r.absent)) for r in rules]
            by_word: dict[int, list[int]] = {}
            for place, (_, groups, _) in enumerate(coded):
                for w in groups[0] if groups else ():
                    by_word.setdefault(w, []).append(place)
            self.lists.append(coded)
            self.always.append([i for i, (_, groups, _) in enumerate(coded) if not groups])
            self.by_word.append(by_word)
        self.automaton = Automaton(list(number))

    def first(self, text: str) -> list[str | None]:
        """Per list the result of the first rule that holds."""
        found, out = self.automaton.found(text), []
        for rules, always, by_word in zip(self.lists, self.always, self.by_word, strict=True):
            places = set(always).union(*[by_word[w] for w in found if w in by_word])
            holds = (rules[i][0] for i in sorted(places) if not rules[i][2] & found and all(g & found for g in rules[i][1]))
            out.append(next(holds, None))
        return out


def first_rules(df: DataFrame, column: str, lists: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """``df`` with a text column per list: the result of its first rule that holds for the text in ``column``, null if none does.

    A null text counts as empty. Each distinct text is walked once.
    """
    book = RuleBook(lists)

    def walk(batches):
        for batch in batches:
            found = [book.first(t or "") for t in batch["text"].to_pylist()]
            columns = [pa.array([f[i] for f in found], pa.string()) for i in range(len(book.names))]
            yield pa.RecordBatch.from_arrays([batch["text"], *columns], names=["text", *book.names])

    schema = "text string, " + ", ".join(f"`{n}` string" for n in book.names)

    def evaluate(texts: DataFrame) -> DataFrame:
        return texts.toDF("text").mapInArrow(walk, schema).withColumnRenamed("text", column)

    return by_distinct(df, [Group((column,), evaluate)])


def first_rules_by(
    df: DataFrame, key: str, column: str, sets: Mapping[str, Mapping[str, Sequence[Rule]]], plain: Mapping[str, Sequence[Rule]] | None = None,
) -> DataFrame:
    """``df`` with a text column per set: the result of the list that the set has for the row's ``key``, null where it has none. ``plain``: lists for all rows."""
    names = {(name, k): f"_{name}_{i}" for name, lists in sets.items() for i, k in enumerate(lists)}
    found = first_rules(df, column, {names[name, k]: rules for name, lists in sets.items() for k, rules in lists.items()} | dict(plain or {}))
    picked = {name: F.try_element_at(F.create_map(*[x for k in lists for x in (F.lit(k), F.col(names[name, k]))]), F.col(key)) for name, lists in sets.items()}
    return found.withColumns(picked).drop(*names.values())
