"""The complete jobs. Each module has the pure transforms and the job that
reads, transforms and writes below a data root."""
