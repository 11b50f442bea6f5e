"""From raw documents to token ids in five stages, each over all that the one before it kept."""

from brambler.llm.pipeline import ORACLE_SQL, STAGES, lines, mixing, near_duplicates, run, tokens, toxicity  # noqa: F401
