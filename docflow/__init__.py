"""docflow: typed extraction from XML documents and reference-data enrichment on Spark DataFrames."""

from .functions.registry import register, register_python
from .jobs import enrich, enrich_and_append, extract_xml_and_append, extract_xml_and_route, transform_and_filter
from .operators.lookup import apply_with_reference, lookup_with_default
from .operators.partition import drop_rows_in_partitions, map_partitions
from .operators.records import align_to_schema
from .operators.xml import explode_records, extract_xml, read_xml, read_xml_documents, read_xml_files
from .plans.spec import MappingSpec, SpecError, from_json, load
from .session import bounded_broadcast, derived_table, get_session, intermediates, materialize, shared_dir
from .sources.sinks import SinkSchemaError, append_once, read_sink

__all__ = [
    "MappingSpec",
    "SinkSchemaError",
    "SpecError",
    "align_to_schema",
    "append_once",
    "apply_with_reference",
    "bounded_broadcast",
    "derived_table",
    "drop_rows_in_partitions",
    "enrich",
    "enrich_and_append",
    "explode_records",
    "extract_xml",
    "extract_xml_and_append",
    "extract_xml_and_route",
    "from_json",
    "get_session",
    "intermediates",
    "load",
    "lookup_with_default",
    "map_partitions",
    "materialize",
    "read_sink",
    "read_xml",
    "read_xml_documents",
    "read_xml_files",
    "register",
    "register_python",
    "shared_dir",
    "transform_and_filter",
]
