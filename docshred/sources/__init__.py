from docshred.sources.dictionary import (dictionary_names, dictionary_schema,
                                        read_dictionary, write_dictionary)
from docshred.sources.documents import (CORRUPT, DOCUMENT_SCHEMA, document_schema,
                                        malformed, parse_documents, read_documents,
                                        stage_documents, well_formed)
from docshred.sources.sinks import read_tables, register_views, write_table, write_tables

__all__ = [
    "CORRUPT", "DOCUMENT_SCHEMA", "dictionary_names", "dictionary_schema", "document_schema",
    "malformed", "parse_documents", "read_dictionary", "read_documents", "read_tables",
    "register_views", "stage_documents", "well_formed", "write_dictionary", "write_table",
    "write_tables",
]
