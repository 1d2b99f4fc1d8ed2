"""layerwell: layered event-analytics tables on PySpark.

Files land, become typed and de-duplicated tables, roll up into daily and
monthly metrics, and are published. Every step is a DataFrame-to-DataFrame
function, so Spark plans, prunes and distributes the whole chain.
"""

from layerwell.session import build_session, require_utc, scratch_path
from layerwell.spec import ColumnSpec, PipelineConfig, SourceSpec, TableSpec

__all__ = [
    "ColumnSpec",
    "PipelineConfig",
    "SourceSpec",
    "TableSpec",
    "build_session",
    "require_utc",
    "scratch_path",
]
