"""Word lists and patterns as parameters: every classifier takes one of these.

The presets of the check corpus hold strings that occur in it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lexicon:
    """Named groups of lower-case strings (``terms``) or patterns, in order of priority."""

    groups: dict[str, tuple[str, ...]]
    default: str = ""
    patterns: bool = False

    def hits(self, text: Column, name: str) -> Column:
        if self.patterns:
            return text.rlike("|".join(f"(?:{p})" for p in self.groups[name]))
        return F.exists(F.array(*[F.lit(t) for t in self.groups[name]]), lambda t: F.contains(text, t))

    def first(self, text: Column) -> Column:
        """The first group that hits, else the default."""
        out = F.lit(self.default)
        for name in reversed(self.groups):
            out = F.when(self.hits(text, name), name).otherwise(out)
        return out

    def all(self, text: Column, most: int | None = None) -> Column:
        """Names of all groups that hit, in order; the default alone if none."""
        found = F.array_compact(F.array(*[F.when(self.hits(text, n), n) for n in self.groups]))
        found = F.slice(found, 1, most) if most else found
        return F.when(F.size(found) == 0, F.array(F.lit(self.default))).otherwise(found) if self.default else found

    def matched(self, text: Column) -> Column:
        """The terms that occur, in order."""
        return F.filter(F.array(*[F.lit(t) for g in self.groups.values() for t in g]), lambda t: F.contains(text, t))


def contains_any(text: Column, terms: tuple[str, ...]) -> Column:
    return F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(text, t))


@dataclass(frozen=True)
class Corpus:
    """Preset of the synthetic corpus."""

    relevant: Lexicon = field(default_factory=lambda: Lexicon({"relevant": ("ation", "chung", "mente ", "eaux")}))
    #: The condition in focus, the neighbouring one, and words for both at once.
    focus: tuple[str, ...] = (" the ",)
    other: tuple[str, ...] = (" les ", " des ")
    general: tuple[str, ...] = (" und ", " el ")
    topics: Lexicon = field(default_factory=lambda: Lexicon({"stone": ("tion ",), "thing": ("ing ",), "rest": ("erst",), "each": ("able",), "lich": ("lich",), "keit": ("keit",), "euse": ("eaux",), "ment": ("ment ",), "cion": ("ción",)}, default="core"))
    contexts: Lexicon = field(default_factory=lambda: Lexicon({"licensed": ("licen[sc]e",), "contact": ("[a-z0-9.]+@[a-z0-9.-]+",), "numbered": ("[0-9]{4}",), "tabular": (r" \| ",)}, default="general", patterns=True))
    boundaries: Lexicon = field(default_factory=lambda: Lexicon({"emergency": ("^then? ", "^und "), "dose": ("ation", "ción"), "diagnosis": ("ing ", "ung "), "stop": ("tion[.?]",)}, default="none", patterns=True))
    critic: Lexicon = field(default_factory=lambda: Lexicon({"directive": ("the the", "and and"), "cause": ("tion",), "number": ("[0-9]",), "address": ("@",), "long": ("^.{400}",)}, patterns=True))
    denied: Lexicon = field(default_factory=lambda: Lexicon({"secret": ("password=", "akia[0-9a-z]{16}"), "contact": ("[a-z0-9.]+@[a-z0-9.-]+", r"\+[0-9] \("), "network": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",)}, patterns=True))
    gap_terms: tuple[str, ...] = ("idiot", "moron", "scum")


CORPUS = Corpus()
