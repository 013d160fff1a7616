"""Small file-system operations the DataFrame API has no verb for, through the Hadoop
FileSystem of each path's scheme (HDFS, object stores, local): moving a batch's
landing files (K6, K7), listing a folder's direct children, removing a folder.
All are driver-side metadata calls on bounded lists (a batch's files, a few folders).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, p: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(p)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system's scheme and authority."""
    return _fs_path(spark, path)[1].toString().rstrip("/")


def scan_roots(df) -> list[str]:
    """Qualified root folders of the file scans in a frame's plan."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() != "HadoopFsRelation":
            continue
        paths = relation.location().rootPaths()
        out += [qualified(df.sparkSession, paths.apply(j).toString()) for j in range(paths.size())]
    return out


def move_files(spark: SparkSession, paths: list[str], landing: str, dest_root: str) -> list[str]:
    """Move ``paths`` (below ``landing``) to the same relative place below ``dest_root``.

    Keeps the path relative to the landing root, so equal basenames in
    different folders stay apart. If the place is taken by an earlier delivery,
    the new file's modification time is added to its name; nothing is replaced.
    Across file systems the file is copied, and its source deleted once the copy
    is complete. Files already gone (moved by an earlier attempt) are skipped; a
    move that fails raises.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    _, root = _fs_path(spark, landing)
    root_s = root.toString().rstrip("/") + "/"
    moved = []
    for p in paths:
        fs, src = _fs_path(spark, p)
        s = src.toString()
        rel = s[len(root_s):] if s.startswith(root_s) else src.getName()
        if not fs.exists(src):
            continue
        dest_fs, dst = _fs_path(spark, f"{dest_root.rstrip('/')}/{rel}")
        if dest_fs.exists(dst):
            stem, dot, ext = dst.getName().rpartition(".")
            version = fs.getFileStatus(src).getModificationTime()
            name = f"{stem}-{version}.{ext}" if dot else f"{ext}-{version}"
            dst = jvm.org.apache.hadoop.fs.Path(dst.getParent(), name)
        dest_fs.mkdirs(dst.getParent())
        if fs.getUri().equals(dest_fs.getUri()):
            done = fs.rename(src, dst)
        else:  # overwrite=True: a half-written copy of an interrupted attempt
            done = jvm.org.apache.hadoop.fs.FileUtil.copy(fs, src, dest_fs, dst, True, True, conf)
        if not done:
            raise OSError(f"could not move {s} to {dst.toString()}")
        moved.append(dst.toString())
    return moved


def file_versions(spark: SparkSession, paths: list[str]) -> tuple[tuple[str, int, int], ...]:
    """(path, length, modification time) of a few files."""
    out = []
    for p in paths:
        fs, path = _fs_path(spark, p)
        status = fs.getFileStatus(path)
        out.append((p, int(status.getLen()), int(status.getModificationTime())))
    return tuple(out)


def child_dirs(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """Direct sub-folders of ``folder`` as (name, committed); committed = holds ``_SUCCESS``."""
    fs, root = _fs_path(spark, folder)
    if not fs.exists(root):
        return []
    folders = sorted(st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory())
    if not folders:
        return []
    # all markers in one call
    marked = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, "*/_SUCCESS")) or []
    committed = {st.getPath().getParent().getName() for st in marked}
    return [(name, name in committed) for name in folders]


@dataclass(frozen=True)
class FileInfo:
    path: str
    name: str
    is_folder: bool
    modified: int  # ms


def child_files(spark: SparkSession, folder: str) -> list[FileInfo]:
    """Direct children of ``folder``; one listing call. Paths are written as Spark's readers write them."""
    fs, root = _fs_path(spark, folder)
    if not fs.exists(root):
        return []
    return [FileInfo(st.getPath().toString(), st.getPath().getName(), bool(st.isDirectory()),
                     int(st.getModificationTime())) for st in fs.listStatus(root)]


def child_entries(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """Direct children of ``folder`` as (name, is_folder); one listing call."""
    fs, root = _fs_path(spark, folder)
    if not fs.exists(root):
        return []
    return sorted((st.getPath().getName(), bool(st.isDirectory())) for st in fs.listStatus(root))


def rename_dir(spark: SparkSession, src: str, dst: str) -> None:
    """Renames a folder; nothing happens if ``src`` is gone and ``dst`` is there (done before)."""
    fs, a = _fs_path(spark, src)
    _, b = _fs_path(spark, dst)
    if not fs.exists(a) and fs.exists(b):
        return
    fs.mkdirs(b.getParent())
    if fs.exists(b) or not fs.rename(a, b):
        raise OSError(f"could not rename {src} to {dst}")


def delete_dir(spark: SparkSession, folder: str) -> None:
    fs, p = _fs_path(spark, folder)
    fs.delete(p, True)
