"""Settings of the jobs, read on the driver: workspace paths, prompts, dataset rules."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, fields
from pathlib import Path

from docmill.operators import candidates as cand
from docmill.operators.dataset import Rules

#: Folders of a workspace, relative to its root.
FOLDERS = {"raw": "raw", "normalized": "normalized/json", "semantic": "semantic/json", "index": "indices/vectors", "candidates": "qa_candidates/jsonl", "final": "qa_final", "logs": "logs"}


@dataclass(frozen=True)
class Workspace:
    """A root and its folders; ``DOCMILL_WORKSPACE`` or a paths file name the root where it is not given."""

    root: str
    folders: dict[str, str]

    def path(self, name: str) -> str:
        if name not in self.folders:
            raise KeyError(f"unknown folder {name!r}; known: {', '.join(sorted(self.folders))}")
        return f"{self.root.rstrip('/')}/{self.folders[name]}"


def read_json(path: str) -> dict:
    found = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(found, dict):
        raise ValueError(f"{path}: a JSON object is needed")
    return found


def workspace(root: str | None = None, paths_file: str | None = None) -> Workspace:
    """Root by argument, environment, then paths file, then the working folder; the paths file may rename folders."""
    known = read_json(paths_file) if paths_file else {}
    chosen = root or os.environ.get("DOCMILL_WORKSPACE") or known.get("workspace_root") or "."
    return Workspace(chosen, FOLDERS | {k: v for k, v in known.items() if k in FOLDERS})


@dataclass(frozen=True)
class Prompts:
    """System texts and templates of the two passes; templates hold {CONTEXT}, {MAX_QA_PER_GROUP} and {PLAN_JSON}."""

    plan_system: str
    plan_template: str
    generate_system: str
    generate_template: str


DEFAULT_PROMPTS = Prompts(
    "You plan questions about technical texts.",
    "Read the chunks and answer with a JSON array of one plan object with two takeaways.\n\n{CONTEXT}",
    "You write questions and answers about technical texts.",
    "Write at most {MAX_QA_PER_GROUP} questions with answers as a JSON array.\nPlan: {PLAN_JSON}\n\n{CONTEXT}",
)


def load_prompts(path: str) -> Prompts:
    """Prompts of a file; every key is needed and must not be blank."""
    found = read_json(path)
    for f in fields(Prompts):
        if not isinstance(found.get(f.name), str) or not found[f.name].strip():
            raise ValueError(f"{path}: {f.name} is missing or empty")
    return Prompts(*[found[f.name] for f in fields(Prompts)])


@dataclass(frozen=True)
class Generation:
    """Settings of candidate generation; what they hash to is kept with every candidate."""

    top_k: int = 40
    max_neighbors: int = 15
    threshold: float = 0.0
    max_qa: int = 2
    #: Questions of a run over all documents (0: no limit), and whether documents have caps by their size.
    limit: int = 60_000
    document_caps: bool = True
    languages: tuple[str, ...] = cand.LANGUAGES
    trust_levels: tuple[str, ...] = cand.TRUST
    roles: tuple[str, ...] = cand.ROLES
    content_types: tuple[str, ...] = cand.CONTENT_TYPES
    artifacts_excluded: tuple[str, ...] = ()
    least_chars: int = cand.LEAST_CHARS
    #: What is written down about the model.
    llm: tuple[tuple[str, str], ...] = ()


def load_generation(path: str) -> Generation:
    """Settings of candidate generation from a file with ``filters``, ``neighbors``, ``sampling`` and ``llm``; what is absent keeps its default."""
    given = read_json(path)
    # The names in the file.
    names = {
        "languages": ("filters", "languages_allowed"), "trust_levels": ("filters", "trust_levels_allowed"), "roles": ("filters", "chunk_roles_allowed"), "content_types": ("filters", "content_types_allowed"),
        "artifacts_excluded": ("filters", "artifact_roles_excluded"), "least_chars": ("filters", "min_content_chars"), "top_k": ("neighbors", "top_k_faiss"), "max_neighbors": ("neighbors", "max_neighbors"),
        "threshold": ("neighbors", "similarity_threshold"), "limit": ("sampling", "global_qa_limit"), "max_qa": ("sampling", "max_qa_per_group"), "document_caps": ("sampling", "max_qa_per_document"),
    }
    found = {ours: given[part][name] for ours, (part, name) in names.items() if name in given.get(part, {})}
    found = {k: tuple(v) if isinstance(v, list) else v for k, v in found.items()}
    if "document_caps" in found:
        found["document_caps"] = not (isinstance(found["document_caps"], int) and found["document_caps"] <= 0)
    if "llm" in given:
        found["llm"] = tuple(sorted((k, str(v)) for k, v in given["llm"].items()))
    return Generation(**found)


def load_rules(path: str) -> Rules:
    """Dataset rules of a file's ``filters``; what is absent keeps its default."""
    given = read_json(path).get("filters", {})
    names = {
        "least_question": "min_question_chars", "most_question": "max_question_chars", "least_answer": "min_answer_chars", "most_answer": "max_answer_chars",
        "languages": "languages_allowed", "trust_levels": "trust_levels_allowed", "content_types": "content_types_allowed", "need_sources": "require_nonempty_sources",
        "drop_mismatch": "drop_if_language_mismatch",
    }
    return Rules(**{ours: tuple(given[theirs]) if isinstance(given[theirs], list) else given[theirs] for ours, theirs in names.items() if theirs in given})
