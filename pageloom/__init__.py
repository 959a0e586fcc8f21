"""pageloom: document-corpus processing as ordered relations on Spark."""
