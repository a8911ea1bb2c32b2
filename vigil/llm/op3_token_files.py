"""Token ids of whole texts in seekable compressed files, in the order of the ids."""

import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vigil.llm import vocabulary
from vigil.llm.passages import portions
from vigil.llm.registry import register, table
from vigil.llm.seekable import IdReader, IdWriter, filesystem
from vigil.llm.workers import record_batch, texts
from vigil.plans.scratch import materialize, scratch_path

END_ID = 2
FRAME_IDS = 65_536
BATCH_BYTES = 8 << 20


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID,
              id_col: str = "doc_id", text_col: str = "text", frame_ids: int = FRAME_IDS) -> DataFrame:
    """Write one file per range of ids; return the manifest, one row per file.

    Manifest: file (its number in the order of ids), path, n_docs, n_ids, and
    start (ids in the files before). Documents are in ascending order of id,
    null ids first, rows of equal id by a hash of the text, so the ranges split
    there too. Null texts are empty: only the end id. An empty table gives an
    empty manifest. A task that is run again writes another file; the manifest
    names the one that counts.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    order = ["id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = StructType.fromDDL("file bigint, path string, n_docs bigint, n_ids bigint")
    arrow = to_arrow_schema(schema)

    def write(batches):
        encoder = vocabulary.word_encoder(tokenizer)
        width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = vocabulary.pack([end_id])
        context = TaskContext.get()
        path = f"{folder}/{context.partitionId():06d}-{context.taskAttemptId()}.zst"
        store, place = filesystem(path)
        writer = stream = None
        for batch in batches:
            ids, data = batch.column("id").to_pylist(), texts(batch, "text")
            for begin, stop in portions(data, BATCH_BYTES):
                if writer is None:
                    store.create_dir(place.rpartition("/")[0], recursive=True)
                    stream = store.open_output_stream(place, compression=None)
                    writer = IdWriter(stream, batch.column("id").type, width, frame_ids)
                for i, packed in zip(ids[begin:stop], encoder.encode_batch(data[begin:stop])):
                    writer.add(i, packed + end)
        if writer is not None:
            writer.close()
            stream.close()
            yield record_batch({"file": [context.partitionId()], "path": [path],
                                "n_docs": [len(writer.sizes)], "n_ids": [sum(writer.sizes)]}, arrow)

    manifest, _ = materialize(dealt.mapInArrow(write, schema), "manifest")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_ids(manifest: DataFrame, id_type: str = "bigint", wanted: list | None = None) -> DataFrame:
    """id, start, n_tokens and ids (array<int>) of each document, or of the wanted ids only."""

    def each(reader, position, ids):
        return ids.astype(np.int32)

    return _read(manifest, id_type, wanted, "ids array<int>", "ids", each)


def read_checksums(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """id, start, n_tokens and ids_crc32 of each document."""

    def each(reader, position, ids):
        return zlib.crc32(ids.astype("<u4").tobytes())

    return _read(manifest, id_type, None, "ids_crc32 bigint", "ids_crc32", each)


def _read(manifest, id_type, wanted, column, name, each) -> DataFrame:
    schema = StructType.fromDDL(f"id {id_type}, start bigint, n_tokens bigint, {column}")
    arrow = to_arrow_schema(schema)
    keep = None if wanted is None else set(wanted)

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                store, place = filesystem(path)
                with store.open_input_file(place) as source:
                    reader = IdReader(source)
                    ids = reader.ids.to_pylist()
                    chosen = [i for i in range(len(ids)) if keep is None or ids[i] in keep]
                    for at in range(0, len(chosen), 4096):
                        some = chosen[at:at + 4096]
                        yield record_batch({
                            "id": [ids[i] for i in some],
                            "start": [start + int(reader.starts[i]) for i in some],
                            "n_tokens": [int(reader.sizes[i]) for i in some],
                            name: [each(reader, i, reader.document(i)) for i in some]}, arrow)

    files = max(1, manifest.count())
    return manifest.select("path", "start").repartition(files).mapInArrow(read, schema)


@register("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = write_ids(table(spark, sf_dir, "documents"),
                         public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "ids"))
    return read_checksums(manifest).withColumnRenamed("id", "doc_id")
