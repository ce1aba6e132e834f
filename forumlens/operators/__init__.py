"""DataFrame -> DataFrame operators.  Column names are arguments with the
Q&A defaults; no operator collects unbounded data to the driver."""
