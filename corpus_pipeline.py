"""From raw documents to a mixture: quality, near-duplicates, benchmark passages, personal data, mixing."""

from voxtab.llm.stages import STAGES, run

#: Training, fingerprints and alignments have no SQL form; the tests hold each stage against a plain one.
ORACLE_SQL = None

__all__ = ["ORACLE_SQL", "STAGES", "run"]
