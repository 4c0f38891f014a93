"""All SQL equivalents: those of the single queries, of files, of planted faults, and of the joined stages."""

from __future__ import annotations

from curvelake.plans import chain_sql, dispersion_sql, faults_sql, landing_sql, sql

ORACLES: dict[str, str] = sql.ORACLES | landing_sql.ORACLES | faults_sql.ORACLES | dispersion_sql.ORACLES | chain_sql.ORACLES
