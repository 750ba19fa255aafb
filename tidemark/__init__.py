"""Environmental-DNA metabarcoding analytics as Spark DataFrame operators."""

from tidemark.session import build_session, cut_lineage, shared_dir

__all__ = ["build_session", "cut_lineage", "shared_dir"]
