"""The batch jobs as chains of operators. Fits, fills and scaling start jobs; what they return is lazy unless it says otherwise."""
