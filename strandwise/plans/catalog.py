"""All queries outside the llm subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from strandwise.plans import batch, composite, evidence, reference, relational, views

QUERIES: dict = evidence.QUERIES | reference.QUERIES | batch.QUERIES | composite.QUERIES | relational.QUERIES | views.QUERIES
ORACLES: dict[str, str] = evidence.ORACLES | reference.ORACLES | batch.ORACLES | composite.ORACLES | relational.ORACLES | views.ORACLES
