from docshred.operators.combine import count_rows, drop_complete_duplicates, union_tables
from docshred.operators.quality import actual_metrics, expected_counts, quality_report, row_count_checks
from docshred.operators.shredder import occurring_items, shred, widen

__all__ = ["actual_metrics", "count_rows", "drop_complete_duplicates", "expected_counts", "occurring_items",
           "quality_report", "row_count_checks", "shred", "union_tables", "widen"]
