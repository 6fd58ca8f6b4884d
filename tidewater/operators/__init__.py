"""DataFrame operators over topic logs: topic selection, offsets, admission, loss detection, sink projection."""
