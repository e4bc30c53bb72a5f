from storeloom.streaming.incremental import load_new_files

__all__ = ["load_new_files"]
