"""Folders listed and files read inside tasks, through handles instead of cells.

Only names, sizes and digests come back to Spark. The functions are made by
factories, so that executors need no copy of this package to run them.
"""

#: Schemes that tasks open by themselves; others go through Spark's own readers.
SCHEMES = ("file", "hdfs", "gs")

LISTED = "path string, size bigint, event_time bigint, folder boolean, hidden boolean"
DIGESTS = "path string, size bigint, digest string"
WRITTEN = "path string, size bigint"
#: Rows of a batch that goes back to Spark, and bytes of a file that are held at once.
BATCH_ROWS, READ_BYTES = 10_000, 1 << 20


def _opener():
    def opened(path: str):
        """File system and its own name for a path as storage spells it."""
        from pyarrow import fs

        scheme, _, rest = path.partition(":")
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")
        authority, _, name = rest.removeprefix("//").partition("/")
        system, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
        return system, f"{root.rstrip('/')}/{name}"

    return opened


def _batcher():
    def batches_of(rows, schema, size: int):
        import itertools

        import pyarrow as pa

        rows = iter(rows)
        while page := list(itertools.islice(rows, size)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*page), schema)], schema=schema)

    return batches_of


def lister(schema):
    """Task function: folders (path, hidden) to what stands in them, by the schema LISTED.

    Names are judged as Spark's readers do: hidden are those that begin with a dot
    or an underscore (unless they hold =), and all below a hidden folder. Checksum
    files of the local file system are left out, as Hadoop does, and folders that
    are gone by now hold nothing.
    """
    opened, batches_of, size = _opener(), _batcher(), BATCH_ROWS

    def entries(path: str, hidden: bool):
        from pyarrow import fs

        system, folder = opened(path)
        local = path.startswith("file:")
        for f in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            name = f.base_name
            if f.type == fs.FileType.NotFound or local and name.startswith(".") and name.endswith(".crc"):
                continue
            skipped = name.startswith(".") or name.endswith("._COPYING_") or name.startswith("_") and "=" not in name
            is_folder = f.type == fs.FileType.Directory
            yield (f"{path.rstrip('/')}/{name}", 0 if is_folder else f.size, (f.mtime_ns or 0) // 1_000_000,
                   is_folder, hidden or skipped)

    def listed(batches):
        for batch in batches:
            both = zip(batch.column("path").to_pylist(), batch.column("hidden").to_pylist())
            yield from batches_of((e for path, hidden in both for e in entries(path, hidden)), schema, size)

    return listed


def digester(schema):
    """Task function: files (path) to path, size and SHA-256, by the schema DIGESTS.

    A file of any size is read in pieces of READ_BYTES. One that is gone raises.
    """
    opened, batches_of, size, step = _opener(), _batcher(), BATCH_ROWS, READ_BYTES

    def digest(path: str):
        import hashlib

        system, name = opened(path)
        found, length = hashlib.sha256(), 0
        # Files are read as they are, compressed ones too.
        with system.open_input_stream(name, compression=None) as stream:
            while piece := stream.read(step):
                found.update(piece)
                length += len(piece)
        return path, length, found.hexdigest()

    def digested(batches):
        for batch in batches:
            yield from batches_of(map(digest, batch.column("path").to_pylist()), schema, size)

    return digested


def line_filer(root: str, schema):
    """Task function: (folder, line), sorted by folder, to the text files root/folder, by the
    schema WRITTEN. A null line is empty; a repeated task writes the same files again."""
    opened, batches_of, size = _opener(), _batcher(), BATCH_ROWS

    def written(batches):
        import itertools

        system, base = opened(root)
        pairs = (p for b in batches for p in zip(b.column("folder").to_pylist(), b.column("line").to_pylist()))

        def files():
            for folder, run in itertools.groupby(pairs, lambda p: p[0]):
                system.create_dir(f"{base}/{folder}")
                length = 0
                with system.open_output_stream(f"{base}/{folder}/part-00000.txt") as stream:
                    for _, line in run:
                        data = ((line or "") + "\n").encode()
                        stream.write(data)
                        length += len(data)
                yield f"{root}/{folder}/part-00000.txt", length

        yield from batches_of(files(), schema, size)

    return written
