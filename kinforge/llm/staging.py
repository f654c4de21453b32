"""Tables between the steps of an operator; see sources.shared."""

from ..sources.shared import SETTING, file_system, new_path, scope, shared_folder, stage

__all__ = ["SETTING", "file_system", "new_path", "scope", "shared_folder", "stage"]
