"""Finds authors who post the same or nearly the same text again and again."""

from reecho.params import MatchParams
from reecho.plans.matching import Matching, find_pairs
from reecho.session import build_session, tune
from reecho.workspace import Workspace

__all__ = ["MatchParams", "Matching", "Workspace", "build_session", "find_pairs", "tune"]
