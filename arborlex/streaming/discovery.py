"""Discovery over a stream of documents: micro-batches instead of epochs.

foreachBatch labels a micro-batch, appends it to the log under its batch id (a batch
that is run again replaces itself) and maintains the taxonomy when enough documents
have come since the last time. A document that comes twice is an error, as in the
batch program; the ids in the log tell, no state is kept for it. The log itself is read
once, when the stream starts; after that each batch adds to what is known of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from arborlex.operators import labels_log as G
from arborlex.operators.inference import Labeler
from arborlex.operators.storage import cut, exists, narrow_join
from arborlex.operators.taxonomy import TaxonomyError, load, save
from arborlex.plans.discover import DiscoveryLog, Maintainer, label_epoch, maintain


def discover_stream(docs: DataFrame, labeler: Labeler, m: Maintainer, folder: str, checkpoint: str, **trigger) -> StreamingQuery:
    """docs: a stream of doc_id and text; `folder` holds a saved taxonomy that isn't
    frozen. By default takes what there is and stops."""
    state, log_dir = f"{folder}/taxonomy_state.json", f"{folder}/discovery"
    if not exists(state):
        raise TaxonomyError(f"{folder} has no taxonomy")
    known: list[DiscoveryLog] = []  # of this run, once a batch has come

    def batch(rows: DataFrame, batch_id: int) -> None:
        t = load(state)
        if t.frozen:
            raise TaxonomyError("the taxonomy is frozen")
        epoch = batch_id + 1
        if not known:
            known.append(DiscoveryLog(rows.sparkSession, log_dir, t))
        log = known[0]
        if epoch not in log.last:  # else done, but the stream broke off before it could say so
            new = cut(rows.select("doc_id", "text"), "batch")
            # of the log only ids are read, and those of the batch are sent to them
            again = narrow_join(log.all().select("doc_id"), new.select("doc_id"), "doc_id", "left_semi")
            if twice := G.duplicates(new, "doc_id").first() or again.first():
                raise TaxonomyError(f"document {twice.doc_id} came twice")
            log.append(label_epoch(new, labeler, t, log.latest + 1), t, epoch)
        if log.latest - t.last_screened_seq >= t.settings.screen_every:
            save(maintain(log, t, m), state)

    writer = docs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
