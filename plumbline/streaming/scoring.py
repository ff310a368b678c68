"""Predictions for rows that keep arriving."""

from plumbline.session import scratch


def score_stream(model, stream, path, checkpoint, trigger=None, **predict):
    """Starts a query that appends the predictions of each batch of rows to ``path``.

    Batches are predicted as tables, so a model whose search needs a shuffle
    scores a stream too. The batch id is part of the folder, so a batch that is
    run again after a failure replaces its own rows. The default trigger reads
    what is there and stops.
    """

    def score(batch, batch_id):
        # What a search stores for this batch goes with it; a model's own tables stay.
        with scratch(batch.sparkSession):
            model.predict(batch, **predict).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
