"""Fixed values of the data model. They are parameters everywhere; these are the defaults."""

# Classes a record may be given, and the four a repository label can stand for.
CLASSES = ["bug", "feature", "docs", "question", "other"]
WEAK_CLASSES = ["bug", "feature", "docs", "question"]

# States of a record and the fields every record must have.
STATES = ["open", "closed"]
REQUIRED_FIELDS = ["id", "repo", "number", "title", "state", "created_at", "updated_at"]

# Parts of label names that hint at a class.
LABEL_TERMS = ["bug", "feature", "enhance", "doc", "support", "question"]

# Scoring limits.
MAX_COST_USD = 4.20
RESERVE_USD = 0.02
PRICE_PER_MILLION_TOKENS = 0.042
BODY_CHARS = 4000
LOW_CONFIDENCE = 0.6

# How many records to keep per repository, in this order, and in all.
REPO_CAPS = {
    "fastapi/fastapi": 4_000,
    "microsoft/vscode": 50_000,
    "kubernetes/kubernetes": 20_000,
    "pytorch/pytorch": 20_000,
    "tensorflow/tensorflow": 20_000,
}
TOTAL_CAP = 100_000

# Sampling sizes.
SEED = 42
SAMPLE_PER_CLASS = 500
REVIEW_PER_CLASS = 100
TEST_FRACTION = 0.25
LABELS_PER_REPO = 20
LOWEST_EXAMPLES = 10
ERRORS_SHOWN = 50

# The class each repository label stands for.
LABEL_MAP = {
    "fastapi/fastapi": {
        "bug": "bug",
        "feature": "feature",
        "docs": "docs",
        "question": "question",
    },
    "kubernetes/kubernetes": {
        "kind/bug": "bug",
        "kind/feature": "feature",
        "kind/documentation": "docs",
        "kind/support": "question",
    },
    "microsoft/vscode": {
        "bug": "bug",
        "feature-request": "feature",
        "*question": "question",
    },
    "pytorch/pytorch": {
        "enhancement": "feature",
        "feature": "feature",
        "module: docs": "docs",
        "topic: docs": "docs",
    },
    "tensorflow/tensorflow": {
        "type:bug": "bug",
        "type:feature": "feature",
        "type:docs-bug": "docs",
        "type:docs-feature": "docs",
        "type:support": "question",
    },
}

# What the scorer is asked, by classifier version.
INSTRUCTIONS = "Classify this GitHub issue."
CRITERIA = {
    "v1": {
        "bug": "Broken or incorrect behavior",
        "feature": "Request for new functionality",
        "docs": "Documentation issue",
        "question": "Request for help or information",
        "other": "Anything else",
    },
    "v2": {
        "bug": "Reports a confirmed defect, regression, or behavior that is clearly different from "
        "expected behavior. Do not choose bug only because an error or failure is mentioned.",
        "feature": "Requests new functionality, capability, behavior, or improvement.",
        "docs": "Reports missing, incorrect, unclear, or outdated documentation, or requests a "
        "documentation improvement.",
        "question": "Primarily asks how, why, or whether something works, requests help with usage "
        "or configuration, or describes a problem without clearly proving that the software itself "
        "is defective.",
        "other": "Does not clearly match bug, feature, docs, or question.",
    },
    "v3": {
        "bug": "The issue reports broken, incorrect, failing, crashing, regressed, or unexpectedly "
        "missing behavior in the software. Choose bug when the issue describes a concrete failure "
        "or behavior that should work but does not, even if the author asks for help.",
        "feature": "The issue requests a new capability, behavior, option, optimization, or "
        "improvement that does not currently exist.",
        "docs": "The primary issue is missing, incorrect, unclear, outdated, or misleading "
        "documentation, examples, tutorials, or API documentation.",
        "question": "The primary intent is to ask how, why, whether, or how to configure or use "
        "something. Choose question only when there is no clear evidence of broken or incorrect "
        "software behavior.",
        "other": "The issue does not clearly fit bug, feature, docs, or question.",
    },
}
