"""Files that one of several writers can make."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def publish_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file that holds ``text``, whole or not at all; False if it is there already.

    The text goes to a file of a new name first, which then takes the wanted name only if that is
    free. Of several writers, on any machines and with any clocks, one gets True. On local disks this
    is a hard link; elsewhere a rename that must not overwrite, so the file system has to do that in one
    step, as HDFS does.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    system = target.getFileSystem(conf)
    target = system.makeQualified(target)
    folder = target.getParent()
    draft = hadoop.Path(folder, f"_{uuid.uuid4().hex}")  # readers skip names that begin so
    system.mkdirs(folder)
    if system.getUri().getScheme() == "file":
        here, there = (p.toUri().getPath() for p in (draft, target))
        with open(here, "x", encoding="utf-8") as out:
            out.write(text)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(here, there)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(here)
    out = system.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    modes = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    modes[0] = getattr(hadoop.Options.Rename, "NONE")
    try:
        hadoop.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, modes)
        return True
    except Py4JJavaError as e:
        if not system.exists(target):
            raise
        return False
    finally:
        if system.exists(draft):
            system.delete(draft, False)
