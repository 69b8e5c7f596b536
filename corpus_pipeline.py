"""The corpus pipeline: documents to packed training sequences (see ``moodwatch/llm/pipeline.py``)."""

from moodwatch.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
