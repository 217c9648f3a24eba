"""DataFrame-to-DataFrame operators; unless noted they work on batches and streams alike."""
