"""The views, their builds and the management of releases."""
