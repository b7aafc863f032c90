"""The matching job: documents in, similar pairs out."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reecho.operators import cells, documents, expand
from reecho.params import MatchParams
from reecho.workspace import Workspace

METHODS = ("lsh", "exact")


@dataclass(frozen=True)
class Matching:
    """Result of ``find_pairs``, kept by distinct shingle set.

    ``docs`` is the cheap ``(doc_id, user_id)`` list of all documents, short ones
    included; pairs of documents are built only by ``pairs`` and ``top``. ``set_keys``
    identify a set in both ``shingled`` and ``sets``.
    """

    docs: DataFrame
    shingled: DataFrame
    sets: DataFrame
    set_pairs: DataFrame
    set_keys: tuple[str, ...] = documents.SET_KEYS

    def matched(self, params: MatchParams, method: str, workspace: Workspace | None = None) -> "Matching":
        """The same sets matched again; texts and sets are not made again."""
        workspace = workspace or Workspace.of(self.sets.sparkSession, "match")
        set_pairs = workspace.save(similar_sets(self.sets, self.shingled, params, method), f"set_pairs_{method}")
        return replace(self, set_pairs=set_pairs)

    def members(self) -> DataFrame:
        """The set of every document with enough words."""
        return documents.members(self.shingled, self.sets, self.set_keys)

    def _copied(self) -> DataFrame:
        return documents.members(self.shingled, self.sets.where(F.col("copies") > 1), self.set_keys)

    def pairs(self) -> DataFrame:
        """Every similar pair of documents."""
        return expand.expand_pairs(self.set_pairs, self._copied())

    def top(self, limit: int) -> DataFrame:
        """The most similar pairs, ties by doc ids."""
        largest = self.sets.agg(F.max("copies").alias("n")).first().n or 0
        return expand.top_pairs(self.set_pairs, self._copied(), limit, largest)

    def author_pair_counts(self) -> DataFrame:
        return expand.author_pair_counts(self.set_pairs, self.sets)

    def own_pair_counts(self, doc_users: DataFrame) -> DataFrame:
        """Pairs of each author of ``doc_users``, who may be another one than the scope of the matching."""
        return expand.own_pair_counts(self.set_pairs, self.members(), doc_users)

    def paired_documents(self) -> DataFrame:
        """``(doc_id, user_id)`` of the documents with at least one similar partner."""
        paired = expand.paired_sets(self.set_pairs, self.sets)
        marked = self.sets.join(paired, "rep_id", "left_semi")
        return documents.members(self.shingled, marked, self.set_keys).select("doc_id", "user_id")


def similar_sets(sets: DataFrame, shingled: DataFrame, params: MatchParams, method: str) -> DataFrame:
    """Pairs of sets, compared in cells: only similar ones leave the tasks."""
    if method == "lsh":
        return cells.similar_pairs(sets, params.threshold, shingled=shingled, banding=params)
    if method == "exact":
        return cells.similar_pairs(sets, params.threshold, shingled=shingled)
    raise ValueError(f"method must be one of {METHODS}, not {method!r}")


def prepare(docs: DataFrame, params: MatchParams, workspace: Workspace | None = None) -> tuple[DataFrame, DataFrame]:
    """``(shingled, sets)``, written to the workspace: the text work is done once."""
    workspace = workspace or Workspace.of(docs.sparkSession, "match")
    shingled = workspace.save(documents.shingle_documents(docs, params), "shingled")
    sets = workspace.save(documents.distinct_sets(shingled), "sets")
    return shingled, sets


def find_pairs(
    docs: DataFrame,
    params: MatchParams = MatchParams(),
    method: str = "lsh",
    workspace: Workspace | None = None,
    order: str | None = None,
) -> Matching:
    """Similar pairs within each author of ``docs(doc_id, user_id, text)``.

    A ``doc_id`` delivered again counts once, with its least row, or the earliest by ``order`` if that column is named.

    ``method="lsh"`` finds them through shared MinHash buckets, ``"exact"`` through a
    join that compares all and misses none.
    """
    workspace = workspace or Workspace.of(docs.sparkSession, "match")
    docs = documents.deliver_once(docs, order)
    shingled = workspace.save(documents.shingle_documents(docs, params), "shingled")
    sets = workspace.save(documents.set_facts(shingled), "sets")
    unmatched = Matching(docs.select("doc_id", "user_id"), shingled, sets, sets)
    return unmatched.matched(params, method, workspace)
