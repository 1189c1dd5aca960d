"""weftline: graded training-set construction and corpus operators on Spark DataFrames."""

from .operators.kb import concept_bank, knowledge_bank, records, scene_bank, template_bank
from .operators.planning import plan_rows, replan
from .operators.quota import allocate, mastery, settle
from .operators.review import training_records
from .operators.validate import Limits, decide, precheck, vote_summary
from .plans.assess import answer, score
from .plans.backend import HttpBackend, StubBackend
from .plans.rounds import generate, refine, validate, validate_with_backtracking
from .session import session
from .sources.store import Folder

__version__ = "0.2.0"

__all__ = [
    "Folder", "HttpBackend", "Limits", "StubBackend", "allocate", "answer", "concept_bank", "decide", "generate", "knowledge_bank", "mastery", "plan_rows", "precheck", "records", "refine", "replan", "scene_bank", "score",
    "session", "settle", "template_bank", "training_records", "validate", "validate_with_backtracking", "vote_summary",
]
