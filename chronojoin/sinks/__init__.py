from .save import drop_written, save_dataset, shared_dir

__all__ = ["drop_written", "save_dataset", "shared_dir"]
