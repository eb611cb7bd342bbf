"""Writers for files, SQL text and topics."""
