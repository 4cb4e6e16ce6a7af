"""Opinions of law reports told from their running headers: runs of pages that name one judge."""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

#: Likeness at which two recognised names are one judge's, letters that a name needs, and pages looked ahead.
ONE_JUDGE, FEWEST_LETTERS, AHEAD = 0.55, 3, 4


def _letters(name: str) -> str:
    return "".join(c for c in name.lower() if "a" <= c <= "z")


class _Case:
    """The runs of one case, fed page by page; a page is settled once the pages looked ahead are known."""

    def __init__(self, case: str):
        self.case = case
        self.waiting: deque = deque()
        self.names: Counter = Counter()
        self.first = self.last = None
        self.done: list[tuple] = []

    def feed(self, page: int, name: str) -> None:
        self.waiting.append((page, name))
        if len(self.waiting) > AHEAD:
            self._settle()

    def _settle(self) -> None:
        page, name = self.waiting.popleft()
        if len(_letters(name)) < FEWEST_LETTERS:
            return
        alike = lambda other: tx.ratio(_letters(name), _letters(other)) >= ONE_JUDGE
        goes_on = bool(self.names) and alike(self.names.most_common(1)[0][0])
        if not goes_on:
            stays = not self.waiting or any(alike(n) for _, n in self.waiting)
            if self.names and not stays:  # a garbled header, not another judge
                self.last = page
                return
            self._close()
            self.first = page
        self.names[name] += 1
        self.last = page

    def _close(self) -> None:
        if self.names:
            self.done.append((self.case, len(self.done), self.names.most_common(1)[0][0], self.first, self.last, sum(self.names.values())))
        self.names = Counter()

    def end(self) -> list[tuple]:
        while self.waiting:
            self._settle()
        self._close()
        return self.done


def judge_runs(pages: DataFrame) -> DataFrame:
    """(case_id, run, judge, first_page, last_page, pages): runs of pages whose headers name one judge, from pages(case_id, page, name).

    Names that recognition has garbled belong to the run they are like; a name unlike it opens a run only if one of the next named
    pages confirms it. Pages stream in order through a few pages' state, so no case is gathered. Null names and cases are
    passed over.
    """
    names = ["case_id", "run", "judge", "first_page", "last_page", "pages"]

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        now: _Case | None = None
        for pdf in batches:
            out: list[tuple] = []
            for case, page, name in zip(pdf["case_id"], pdf["page"], pdf["name"], strict=True):
                if now is None or now.case != case:
                    out += now.end() if now else []
                    now = _Case(case)
                now.feed(int(page), name)
            if out:
                yield pd.DataFrame(out, columns=names)
        if now and (out := now.end()):
            yield pd.DataFrame(out, columns=names)

    rows = pages.where("case_id IS NOT NULL AND page IS NOT NULL AND name IS NOT NULL").select("case_id", "page", "name").distinct()
    ordered = rows.repartition("case_id").sortWithinPartitions("case_id", "page", "name")
    return ordered.mapInPandas(run, "case_id string, run int, judge string, first_page int, last_page int, pages int")


def header_names(pages: DataFrame, top: int = 3) -> DataFrame:
    """(case_id, page, name): the judge named in the first lines of each of pages(case_id, page, lines)."""
    named = F.array_compact(F.transform(F.slice("lines", 1, top), tx.header_judge))
    return pages.select("case_id", "page", F.get(named, F.lit(0)).alias("name")).where("name IS NOT NULL")
