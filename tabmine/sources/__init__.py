from tabmine.sources.io import (REVIEW_SCHEMA, load_pipeline_model, normalize_missing, read_doc,
                                read_reviews_csv, read_table, save_model, to_doc, write_doc,
                                write_table)
from tabmine.sources.views import docs_review, orders_review, scored, table

__all__ = ["REVIEW_SCHEMA", "load_pipeline_model", "normalize_missing", "read_doc",
           "read_reviews_csv", "read_table", "save_model", "to_doc", "write_doc", "write_table",
           "docs_review", "orders_review", "scored", "table"]
