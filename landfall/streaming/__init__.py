"""Run-to-completion loads: availableNow streams and changed-file batches
published into commit tables."""
