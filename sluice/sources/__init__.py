from sluice.sources.document_dump import read_document_dump, write_document_dump
from sluice.sources.files import (
    drop_technical_id,
    high_water_mark,
    kafka_options,
    read_csv,
    read_json_documents,
    read_message_stream,
    read_messages,
    read_table,
    read_xml_records,
    with_read_order,
)
from sluice.sources.json_records import read_json_records
from sluice.sources.xml_records import read_root_records

__all__ = [
    "drop_technical_id", "high_water_mark", "kafka_options", "read_csv", "read_document_dump", "read_json_documents",
    "read_json_records", "read_message_stream", "read_messages", "read_root_records", "read_table", "read_xml_records", "with_read_order",
    "write_document_dump",
]
