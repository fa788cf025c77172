"""Small files and renames on whatever file system a path names, through Hadoop's FileSystem."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Files of one session: local paths, or any scheme the cluster knows."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):  # noqa: ANN202
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return bool(system.exists(place))

    def names(self, folder: str) -> list[str]:
        system, place = self._at(folder)
        return sorted(s.getPath().toString() for s in system.listStatus(place))

    def delete(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)

    def replace(self, path: str, target: str) -> None:
        """Rename a finished file over ``target``: atomic where the file system renames atomically."""
        fs = self._jvm.org.apache.hadoop.fs
        source, place = self._at(path)[1], self._at(target)[1]
        context = fs.FileContext.getFileContext(self._at(target)[0].makeQualified(place).toUri(), self._conf)
        context.rename(source, place, self._array(fs.Options.Rename, [fs.Options.Rename.OVERWRITE]))

    def _array(self, kind, items):  # noqa: ANN001, ANN202
        from pyspark import SparkContext

        made = SparkContext._gateway.new_array(kind, len(items))
        for i, item in enumerate(items):
            made[i] = item
        return made

    def read_text(self, path: str) -> str:
        system, place = self._at(path)
        stream = system.open(place)
        try:
            return str(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """The whole file or, after a failure, none: written beside its place and renamed into it."""
        system, place = self._at(f"{path}.partial")
        stream = system.create(place, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.replace(f"{path}.partial", path)

    def concatenate(self, parts: list[str], path: str) -> str:
        """Parts one after another as ``path``, streamed by the driver's JVM; returns the SHA-256 of the whole."""
        digest = self._jvm.java.security.MessageDigest.getInstance("SHA-256")
        system, place = self._at(f"{path}.partial")
        out = self._jvm.java.security.DigestOutputStream(system.create(place, True), digest)
        try:
            for part in parts:
                source, at = self._at(part)
                stream = source.open(at)
                try:
                    self._jvm.org.apache.commons.io.IOUtils.copyLarge(stream, out)
                finally:
                    stream.close()
        finally:
            out.close()
        self.replace(f"{path}.partial", path)
        return str(self._jvm.org.apache.commons.codec.binary.Hex.encodeHexString(digest.digest()))
