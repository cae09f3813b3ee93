"""The library's intermediate tables, under the name that this package uses."""

from ..sources.workspace import Workspace, delete, hadoop_path, partitions, shared_dir

__all__ = ["Workspace", "delete", "hadoop_path", "partitions", "shared_dir"]
