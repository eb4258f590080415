"""Streamed delivery of a batch result: partition by partition, so the driver holds one at a time."""


def stream_query(query, size: int = 1000):
    """Yield lists of up to ``size`` rows."""
    df, batch = query.to_df() if hasattr(query, "to_df") else query, []
    for row in df.toLocalIterator():
        batch.append(row)
        if len(batch) == size:
            yield batch
            batch = []
    if batch:
        yield batch
