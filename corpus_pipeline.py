"""The text-cleaning pipeline of the optional text subpackage, at the place where it is looked for."""

from corroborate.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
