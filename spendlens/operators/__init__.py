"""DataFrame -> DataFrame operators."""

from . import aggregates, dims, joins, kpi, quality, reshape, setops, windows  # noqa: F401
