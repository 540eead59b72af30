"""Small file operations through Hadoop's FileSystem (local, HDFS, object stores alike).

Only metadata-sized files (commit records, state scalars) are read or written here;
table data is always written and read by Spark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class HadoopFS:
    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return bool(self._fs(path).exists(self._path(path)))

    def mkdirs(self, path: str) -> None:
        self._fs(path).mkdirs(self._path(path))

    def list_names(self, path: str, dirs_only: bool = False) -> list[str]:
        if not self.exists(path):
            return []
        out = []
        for st in self._fs(path).listStatus(self._path(path)):
            if dirs_only and not st.isDirectory():
                continue
            out.append(st.getPath().getName())
        return sorted(out)

    def list_files(self, path: str) -> list[str]:
        """Data files (not hidden, not markers) directly under ``path``."""
        if not self.exists(path):
            return []
        return sorted(st.getPath().toString() for st in self._fs(path).listStatus(self._path(path))
                      if st.isFile() and not st.getPath().getName().startswith(("_", ".")))

    def read_text(self, path: str) -> str:
        fs = self._fs(path)
        stream = fs.open(self._path(path))
        try:
            reader = self._jvm.java.io.BufferedReader(
                self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()

    def write_text_atomic(self, path: str, text: str, overwrite: bool = False) -> None:
        """Write to a hidden temp name, then rename into place (publish last)."""
        fs = self._fs(path)
        target = self._path(path)
        tmp = self._path(target.getParent().toString() + "/." + target.getName() + ".tmp")
        out = fs.create(tmp, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if fs.exists(target):
            if not overwrite:
                fs.delete(tmp, False)
                raise FileExistsError(path)
            fs.delete(target, False)
        if not fs.rename(tmp, target):
            raise OSError(f"rename failed: {path}")

    def delete(self, path: str, recursive: bool = True) -> None:
        fs = self._fs(path)
        if fs.exists(self._path(path)):
            fs.delete(self._path(path), recursive)

    def rename(self, src: str, dst: str) -> None:
        if not self._fs(src).rename(self._path(src), self._path(dst)):
            raise OSError(f"rename failed: {src} -> {dst}")

    def set_mtime(self, path: str, mtime_ms: int) -> None:
        self._fs(path).setTimes(self._path(path), int(mtime_ms), -1)
