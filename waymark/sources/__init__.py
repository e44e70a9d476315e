"""Raw record files in, typed landing tables out."""
