"""Column expressions over paths and job ids (all built-in Spark functions)."""

from concord.functions.job_ids import normalize_job_id
from concord.functions.paths import baseline_path, table_name

__all__ = ["baseline_path", "normalize_job_id", "table_name"]
