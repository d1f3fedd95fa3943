"""Reading, writing, registering and inspecting tables and streams."""
