"""Lake objects in, raw tables out: schemas, routing, load ledger, readers and writers."""
